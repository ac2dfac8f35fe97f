"""Joins that hold when one key owns a large share of the rows.

``join_dimension`` broadcasts a side only after measuring it; beyond the bound
it falls back to ``skew_join``, which spreads every hot key of the big side
over several partitions and copies only the matching rows of the other side.
"""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from .checks import hashable_columns, require_choice, require_columns

BROADCAST_BYTES = 64 * 1024 * 1024
# A lookup whose files alone are this many times the bound is not measured first.
HOPELESS = 64
# A key is hot when it holds more than one shuffle partition's fair share and
# more rows than one task takes with ease.
HOT_ROWS = 100_000
# Up to this many hot keys are written into the plan, more are joined.
_INLINE = 64
_MOST_KEYS = 100_000
_UNKNOWN = 1 << 60
# Rows that a task sorts or hashes with ease.
ROWS_PER_TASK = 1_000_000
_FIXED = "tinyint smallint int bigint float double boolean date timestamp timestamp_ntz".split()


def _cell_bytes(field):
    """Bytes of a column in a row: its 8-byte slot and what lies outside of it."""
    kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
    if kind in _FIXED:
        return F.lit(8)
    if kind in ("string", "binary"):
        return 16 + F.coalesce(F.octet_length(column), F.lit(0))
    if kind.startswith("decimal"):
        return F.lit(24)
    # Nested values: their text, doubled for slots and offsets.
    return 16 + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))


def measured_size(df):
    """(rows, bytes) of ``df`` as rows in a hash table, by one small aggregate.

    Null columns count with their slots; every row adds its null bits and the
    table's key and pointers.
    """
    cells = [_cell_bytes(f) for f in df.schema.fields]
    row_bytes = reduce(lambda a, b: a + b, cells, F.lit(48 + 8 * (len(cells) // 64 + 1)))
    row = df.agg(F.count("*").alias("n"), F.sum(row_bytes.cast("long")).alias("b")).first()
    return row["n"], row["b"] or 0


def file_bytes(df):
    """Bytes of the tables that ``df`` is made from, by the optimizer's statistics.

    Tables without statistics count as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN)


def small_enough(df, max_bytes=BROADCAST_BYTES):
    """Whether ``df`` was measured to fit the bound."""
    return file_bytes(df) <= HOPELESS * max_bytes and measured_size(df)[1] <= max_bytes


def _partitions(spark):
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def partitions_for(spark, rows, rows_per_task=ROWS_PER_TASK):
    """As many partitions as keep a task at its rows, the session's number at least."""
    return max(_partitions(spark), -(-rows // rows_per_task))


def key_profile(df, keys, min_rows=None):
    """(rows, {hash of key: number of pieces} for the hot keys) of ``df``.

    One mergeable frequent-items sketch over the key hash: a single pass and one
    row to the driver. At most as many keys as shuffle partitions can hold more than
    a partition's share, and the sketch grows with that number. The estimate
    only steers the split; results do not depend on it.
    """
    require_columns(df, *keys)
    parts = _partitions(df.sparkSession)
    limit = min(max(parts, 16), _MOST_KEYS)
    row = (
        df.select(F.xxhash64(*keys).alias("h"))
        .agg(
            F.count("*").alias("n"),
            F.expr(f"approx_top_k(h, {limit}, {max(10_000, 8 * limit)})").alias("top"),
        )
        .first()
    )
    rows = row["n"]
    least = max(rows / parts, HOT_ROWS if min_rows is None else min_rows)
    hot = {
        item["item"]: -(-item["count"] * parts // rows)
        for item in row["top"] or []
        if item["count"] > least
    }
    return rows, hot


def hot_keys(df, keys, min_rows=None):
    """{hash of key: number of pieces} for the hot keys of ``df``."""
    return key_profile(df, keys, min_rows)[1]


def with_pieces(df, keys, hot, name="__pieces"):
    """``df`` with a column: into how many pieces the row's key is split (1 for cold keys)."""
    if not hot:
        return df.withColumn(name, F.lit(1))
    key_hash = F.xxhash64(*keys)
    if len(hot) <= _INLINE:
        table = F.create_map(*[F.lit(v) for pair in hot.items() for v in pair])
        count = F.when(key_hash.isin(list(hot)), table[key_hash]).otherwise(F.lit(1))
        return df.withColumn(name, count.cast("int"))
    # Bounded by the number of shuffle partitions.
    listed = df.sparkSession.createDataFrame([(k, int(v)) for k, v in hot.items()], "__hot long, __n int")
    joined = df.withColumn("__hot", key_hash).join(F.broadcast(listed), "__hot", "left")
    return joined.withColumn(name, F.coalesce("__n", F.lit(1))).drop("__hot", "__n")


def _matched(left, right, on, how, null_safe):
    """Equi-join on columns that both sides have; null keys match if ``null_safe``."""
    if not null_safe:
        return left.join(right, on, how)
    names = {k: f"__right_{i}" for i, k in enumerate(on)}
    right = right.withColumnsRenamed(names)
    same = [left[k].eqNullSafe(right[n]) for k, n in names.items()]
    return left.join(right, reduce(and_, same), how).drop(*names.values())


def skew_join(left, right, on, how="inner", hot=None, null_safe=False):
    """Equi-join of a possibly skewed ``left`` with ``right``.

    Each hot key of ``left`` is cut into pieces by a hash of the whole row and
    its input partition (stable when a task is run again), and the rows of
    ``right`` with that key are copied once per piece. With ``null_safe``, null
    keys match each other.
    """
    require_choice("join type", how, ("inner", "left"))
    on = list(on)
    require_columns(right, *on)
    for key in on:
        ours, theirs = left.schema[key].dataType, right.schema[key].dataType
        if ours != theirs:
            raise ValueError(f"join key {key}: {ours.simpleString()} vs {theirs.simpleString()}")
    if hot is None:
        hot = hot_keys(left, on)
    if not hot:
        return _matched(left, right, on, how, null_safe)
    spread = F.xxhash64(*hashable_columns(left), F.spark_partition_id())
    left = with_pieces(left, on, hot).withColumn("__piece", F.pmod(spread, F.col("__pieces")).cast("int")).drop("__pieces")
    right = with_pieces(right, on, hot)
    right = right.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))).drop("__pieces")
    return _matched(left, right, [*on, "__piece"], how, null_safe).drop("__piece")


def join_dimension(facts, dim, on, how="inner", max_bytes=BROADCAST_BYTES, null_safe=False):
    """Join ``facts`` with a lookup table: broadcast if measured small, else split.

    A streaming ``facts`` cannot be sampled for hot keys; beyond the bound it
    takes a plain join of each (rate-limited) micro-batch.
    """
    require_choice("join type", how, ("inner", "left"))
    on = list(on)
    require_columns(facts, *on)
    if small_enough(dim, max_bytes):
        return _matched(facts, F.broadcast(dim), on, how, null_safe)
    if facts.isStreaming:
        return _matched(facts, dim, on, how, null_safe)
    return skew_join(facts, dim, on, how, null_safe=null_safe)
