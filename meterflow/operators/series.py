"""Date-indexed and regular series, and the date layout of a text column."""

from pyspark.sql import functions as F

from ..checks import require_columns
from ..functions.timeparts import parse_date
from .latest import latest_per_group
from .ordered import with_next

# Slots that one row makes at a time.
SLOTS = 10_000
LAYOUTS = ("MM-dd-yyyy", "dd-MM-yyyy", "yyyy-MM-dd")


def date_indexed(df, date_column, value_column, layout="MM-dd-yyyy", name="Date"):
    """(date, value) sorted by date. Text that is no date gives a null date."""
    require_columns(df, date_column, value_column)
    day = parse_date(date_column, layout)
    rows = df.select(day.alias(name), value_column, F.spark_partition_id().alias("__part"))
    # The value and input partition take part in the sort, so that a busy day
    # or many equal rows can span slices.
    return rows.orderBy(name, value_column, "__part").drop("__part")


def regular(df, group, ts, columns, step="1 hour", tiebreak=()):
    """One row per group and time step from the group's first to its last: (group, slot, columns, filled).

    A step holds its newest reading (ties by ``tiebreak``); a step without any repeats the last known
    one, with ``filled`` true. Steps count from 1970 in the session's zone if ``ts`` has none. Only readings are
    shuffled: each takes the step of the one after it over range slices and makes the steps up to there
    in pieces where it lies, so one long device may span any number of tasks. Rows without a time are left out.
    """
    group, columns = list(group), list(columns)
    require_columns(df, *group, ts, *columns, *tiebreak)
    kind = df.schema[ts].dataType.simpleString()
    width = df.sparkSession.range(1).select(F.unix_micros(F.expr(f"timestamp_micros(0) + INTERVAL {step}"))).first()[0]
    # Local times are counted as if they were universal ones.
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(kind), F.col(ts))
    slotted = df.select(*dict.fromkeys([*group, ts, *columns, *tiebreak])).where(F.col(ts).isNotNull())
    slotted = slotted.withColumn("__slot", F.floor(micros / width).cast("long"))
    newest = latest_per_group(slotted, [*group, "__slot"], ts, tiebreak)
    held = newest.select(*group, "__slot", F.struct(*columns).alias("__row"))
    linked = with_next(held, group, ["__slot"], ["__slot"])
    linked = linked.withColumn("__b", F.coalesce(F.col("next___slot") - 1, "__slot")).drop("next___slot")
    pieces = linked.withColumn("__a", F.explode(F.sequence("__slot", "__b", F.lit(SLOTS))))
    every = pieces.withColumn("__at", F.explode(F.sequence("__a", F.least("__b", F.col("__a") + SLOTS - 1))))
    at = F.timestamp_add("MICROSECOND", F.col("__at") * width, F.lit("1970-01-01").cast(kind))
    return every.select(*group, at.alias("slot"), *[F.col(f"__row.{c}").alias(c) for c in columns], (F.col("__at") > F.col("__slot")).alias("filled"))


def layout_votes(df, column, layouts=LAYOUTS):
    """(layout, parsed, regular) for each layout: the share of texts it reads, and how evenly its dates follow.

    ``regular`` is the share of the commonest step between neighbouring distinct
    dates; a step is a number of whole months where the day of the month stays,
    else a number of days. Blank texts and nulls have no vote. One pass reads the
    column; the dates of all layouts are linked over range slices.
    """
    require_columns(df, column)
    text = F.trim(F.col(column))
    rows = df.select(text.alias("t")).where("t <> ''").groupBy("t").agg(F.count("*").alias("n"))
    tried = rows.select("n", F.explode(F.array(*[F.struct(F.lit(x).alias("layout"), parse_date("t", x).alias("day")) for x in layouts])).alias("v")).select("n", "v.*")
    days = tried.groupBy("layout", "day").agg(F.sum("n").alias("n"))
    shares = days.groupBy("layout").agg((F.sum(F.when(F.col("day").isNotNull(), F.col("n"))) / F.sum("n")).alias("parsed"))
    linked = with_next(days.where("day IS NOT NULL").select("layout", "day"), ["layout"], ["day"], ["day"]).where("next_day IS NOT NULL")
    months = (F.year("next_day") - F.year("day")) * 12 + F.month("next_day") - F.month("day")
    step = F.when(F.dayofmonth("day") == F.dayofmonth("next_day"), F.concat(months, F.lit(" months"))).otherwise(F.concat(F.datediff("next_day", "day"), F.lit(" days")))
    steps = linked.groupBy("layout", step.alias("step")).agg(F.count("*").alias("n")).groupBy("layout").agg((F.max("n") / F.sum("n")).alias("regular"))
    out = shares.join(steps, "layout", "left")
    return out.select("layout", F.coalesce("parsed", F.lit(0.0)).alias("parsed"), F.coalesce("regular", F.lit(0.0)).alias("regular"))


def date_layout(df, column, layouts=LAYOUTS, margin=0.05):
    """The layout of a text column by vote: the largest share of texts read, then the evenest steps.

    Raises where no layout reads anything, or where the best two are within ``margin`` in both
    figures and read some text as different days: then the column is ambiguous.
    """
    votes = sorted(layout_votes(df, column, layouts).collect(), key=lambda r: (-r["parsed"], -r["regular"], layouts.index(r["layout"])))
    if not votes or votes[0]["parsed"] == 0:
        raise ValueError(f"none of {list(layouts)} reads {column}")
    near = [v for v in votes if votes[0]["parsed"] - v["parsed"] <= margin]
    near.sort(key=lambda r: (-r["regular"], -r["parsed"], layouts.index(r["layout"])))
    best, others = near[0], [v for v in near[1:] if near[0]["regular"] - v["regular"] <= margin]
    for other in others:
        a, b = (parse_date(column, v["layout"]) for v in (best, other))
        if not df.where(a != b).isEmpty():
            raise ValueError(f"{column} can be read as {best['layout']} and as {other['layout']}")
    return best["layout"]
