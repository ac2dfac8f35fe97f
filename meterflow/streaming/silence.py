"""Devices that fall silent: activity closed by event time, and the spells between."""

from pyspark.sql import functions as F

from ..checks import require_columns
from ..operators.ordered import with_next


def active_spells(df, keys, ts="timestamp", limit="1 hour", delay="10 minutes"):
    """(keys, active_from, active_to, readings): a stream's or table's spells of activity.

    A device is active as long as its readings follow each other by less than
    ``limit``. On a stream, run in append mode: a spell is closed, given out once and its state dropped when
    the watermark (the newest time less ``delay``) passes its last reading by ``limit``; so state is
    held for active devices only, and a closed spell reports the device as silent from
    ``active_to`` on. Rows that come later than ``delay`` are dropped. On a table all spells come out.
    """
    keys = list(keys)
    require_columns(df, *keys, ts)
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())
    clocked = df.where(F.col(ts).isNotNull()).withColumn("__at", local)
    if df.isStreaming:
        clocked = clocked.withWatermark("__at", delay)
    spells = clocked.groupBy(*keys, F.session_window("__at", limit).alias("__spell")).agg(F.min(ts).alias("active_from"), F.max(ts).alias("active_to"), F.count("*").alias("readings"))
    return spells.drop("__spell")


def silent_spells(spells, keys):
    """(keys, silent_from, silent_to) between the closed spells of each device; ``silent_to`` is null while it has not come back.

    Spells are linked over range slices, so one device may have any number of them.
    """
    keys = list(keys)
    linked = with_next(spells.select(*keys, "active_from", "active_to"), keys, ["active_from"], ["active_from"])
    return linked.select(*keys, F.col("active_to").alias("silent_from"), F.col("next_active_from").alias("silent_to"))
