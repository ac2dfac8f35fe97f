"""Numeric cleaning of text tables."""

from pyspark.sql import functions as F

from ..checks import require_columns


def to_numeric(df, columns, kind="float"):
    """Columns cast to a number type; text that is no number becomes null."""
    require_columns(df, *columns)
    return df.withColumns({c: F.col(c).try_cast(kind) for c in columns})


def null_counts(df, columns=None):
    """One row per column: name, nulls and non-null rows, in a single pass."""
    columns = list(columns or df.columns)
    require_columns(df, *columns)
    counts = df.agg(
        F.count("*").alias("__rows"), *[F.count(c).alias(c) for c in columns]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col("__rows") - F.col(c)).alias("null_rows"),
            F.col(c).alias("set_rows"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def drop_incomplete(df, columns=None):
    """Rows without a null in any (or any listed) column."""
    if columns is not None:
        require_columns(df, *columns)
    return df.dropna(subset=list(columns) if columns is not None else None)
