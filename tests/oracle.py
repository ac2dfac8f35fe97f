"""Compare a Spark result with DuckDB on the same tables, cell by cell."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "~null"
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def differences(df, con, sql, show=3):
    """Empty when both sides agree, else a short description."""
    names, ours = spark_rows(df)
    theirs_names, theirs = duck_rows(con, sql)
    if names != theirs_names:
        return f"columns {names} vs {theirs_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}; {ours[:show]} vs {theirs[:show]}"
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(pairs)} rows differ: {pairs[:show]}" if pairs else ""
