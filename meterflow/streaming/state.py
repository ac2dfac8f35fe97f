"""Stateful streams: latest rows and running aggregates."""

from pyspark.sql import functions as F

from ..checks import require_choice, require_columns
from ..operators import usage
from ..operators.latest import GRAINS, _newest_order, latest_at


def _with_local_clock(df, ts, expire_after):
    """``__at``: the session's wall clock read as UTC, with the watermark on it.

    Time windows start at whole UTC hours and days, so windows over this column
    are calendar hours and days of the session.
    """
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())
    return df.withColumn("__at", local).withWatermark("__at", expire_after)


def latest_stream(df, keys, grain, ts="timestamp", tiebreak=(), expire_after=None):
    """The latest reading per key and time slot over everything seen so far.

    Run it in update mode. A late, older reading never replaces a newer one.
    State grows with keys and slots unless ``expire_after`` (such as "2 days")
    is given: then slots that long past the newest event are closed and later
    readings for them are dropped.
    """
    if expire_after is None:
        return latest_at(df, keys, grain, ts, tiebreak)
    require_columns(df, *keys, ts)
    require_choice("grain", grain, GRAINS)
    slotted = _with_local_clock(df, ts, expire_after).withColumn("__slot", F.window("__at", f"1 {grain}"))
    rest = [c for c in df.columns if c not in keys]
    order = _newest_order(df, ts, tiebreak, keys)
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return slotted.groupBy(*keys, "__slot").agg(newest).select(*[
        F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns
    ])


def running_profile(df, keys, measures, ts=None, expire_after=None):
    """Minimum, maximum and mean per key group over everything seen so far.

    Run it in complete mode to get all groups each time, or in update mode for
    the changed ones. With ``expire_after``, groups are also cut by day and
    closed that long after the newest event.
    """
    if expire_after is None:
        return usage.profile(df, keys, measures)
    require_columns(df, *keys, *measures, ts)
    daily = _with_local_clock(df, ts, expire_after)
    daily = daily.withColumn("day_window", F.window("__at", "1 day"))
    out = usage.profile(daily, [*keys, "day_window"], measures)
    start = F.to_utc_timestamp("day_window.start", F.current_timezone())
    return out.withColumn("day", F.to_date(start)).drop("day_window")


def running_total(df, keys, measure, name=None):
    return usage.total(df, keys, measure, name)
