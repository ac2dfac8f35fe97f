"""Latest rows per group, newest-first history and top-k."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..checks import hashable_columns, require_choice, require_columns

# Time columns that make up each grain, coarse to fine.
GRAINS = {
    "day": ("date_part",),
    "hour": ("date_part", "hour"),
    "minute": ("date_part", "hour", "minute"),
}
# Above this many rows per group Spark no longer trims groups before a shuffle.
_TRIM_LIMIT = 1000


def grain_columns(grain):
    require_choice("grain", grain, GRAINS)
    return GRAINS[grain]


def _newest_order(df, ts, tiebreak, group):
    """Order columns: event time, then the tiebreak, else every other column."""
    if not tiebreak:
        tiebreak = [c for c in sorted(hashable_columns(df)) if c != ts and c not in group]
    require_columns(df, ts, *tiebreak)
    return [ts, *tiebreak]


def latest_per_group(df, group, ts="timestamp", tiebreak=()):
    """The newest row of each group by event time, then by ``tiebreak``.

    One aggregate with one shuffle, for tables and streams alike. Each task
    keeps one row per group before the shuffle, so a group of any size sends at
    most one row per task. Tables group by a hash of the keys first: the sort
    under the aggregate then compares numbers and rarely the keys themselves.
    """
    group = list(group)
    require_columns(df, *group)
    order = _newest_order(df, ts, tiebreak, group)
    rest = [c for c in df.columns if c not in group]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    keys = group if df.isStreaming else [F.xxhash64(*group).alias("__hash"), *group]
    return df.groupBy(*keys).agg(newest).select(*[
        F.col(c) if c in group else F.col(f"__row.{c}").alias(c) for c in df.columns
    ])


def time_slot(ts, grain):
    """Start of the minute, hour or day on the session's clock."""
    require_choice("grain", grain, GRAINS)
    return F.date_trunc(grain, ts).cast("timestamp_ntz")


def latest_at(df, keys, grain, ts="timestamp", tiebreak=(), columns=None):
    """The latest reading per key and minute, hour or day.

    Needs the event time only; add the text forms of the time to the few rows
    that remain rather than to the input. ``columns`` names the columns wanted
    besides the keys, the time and the tiebreak; only these are carried.
    """
    require_columns(df, *keys, ts)
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, ts, *tiebreak, *columns]))
    slotted = df.withColumn("__slot", time_slot(ts, grain))
    return latest_per_group(slotted, [*keys, "__slot"], ts, tiebreak).drop("__slot")


def latest_rollup(df, keys, ts="timestamp", tiebreak=()):
    """{grain: latest readings}, each grain derived from the next finer one.

    The newest row of an hour is the newest of its minutes' newest rows, so
    only the minute grain reads the input.
    """
    minute = latest_at(df, keys, "minute", ts, tiebreak)
    hour = latest_at(minute, keys, "hour", ts, tiebreak)
    return {"minute": minute, "hour": hour, "day": latest_at(hour, keys, "day", ts, tiebreak)}


def top_n_per_group(df, group, order, n, rank="rank"):
    """The first ``n`` rows of each group in the given order, with their rank.

    ``order`` lists columns, newest or largest first; end it with a unique
    column for a fixed result. Large ``n`` is trimmed in hash pieces of each
    group first, in two rounds, so that no task sorts a whole large group: as
    many pieces as there are shuffle partitions, then the root of that number.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    group, order = list(group), list(order)
    require_columns(df, *group, *order)
    descending = [F.col(c).desc() for c in order]
    if n > _TRIM_LIMIT:
        parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        piece = F.pmod(F.xxhash64(*hashable_columns(df), F.spark_partition_id()), F.lit(parts))
        df = df.withColumn("__piece", piece)
        for pieces in (parts, math.isqrt(parts)):
            first = Window.partitionBy(*group, "__piece").orderBy(*descending)
            df = df.withColumn("__piece", F.pmod("__piece", F.lit(pieces)))
            df = df.withColumn("__rank", F.row_number().over(first)).filter(F.col("__rank") <= n).drop("__rank")
        df = df.drop("__piece")
    window = Window.partitionBy(*group).orderBy(*descending)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def top_k(df, order, k):
    """The first ``k`` rows in descending order, as a top-k without a full sort."""
    require_columns(df, *order)
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(k)
