"""Load over time: step functions of readings that each last a while."""

from pyspark.sql import functions as F

from ..checks import require_columns
from .ordered import running_sums


def load_steps(df, group, start, end, value):
    """The total load per group as a step function: (group, at, load, active) from each change on.

    A row adds ``value`` from ``start`` up to, but not at, ``end``. Changes at the same
    instant are one step. Rows without a start or value, or that end no later
    than they start, add nothing; an open end (null) never takes its value off again. Use whole numbers or
    decimals for exact sums. Changes are pre-summed per group and instant; the running sums go over
    range slices with carried totals, so one group may span any number of tasks.
    """
    group = list(group)
    require_columns(df, *group, start, end, value)
    lasting = df.where(F.col(start).isNotNull() & F.col(value).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    on = F.struct(F.col(start).alias("at"), F.col(value).alias("change"), F.lit(1).cast("long").alias("more"))
    off = F.struct(F.col(end).alias("at"), (-F.col(value)).alias("change"), F.lit(-1).cast("long").alias("more"))
    changes = lasting.select(*group, F.explode(F.array(on, off)).alias("c")).select(*group, "c.*").where("at IS NOT NULL")
    instants = changes.groupBy(*group, "at").agg(F.sum("change").alias("change"), F.sum("more").alias("more"))
    return running_sums(instants, group, ["at"], {"load": "change", "active": "more"}).drop("change", "more")


def peak_load(df, group, start, end, value):
    """(group, peak, peak_at, active): the highest load of each group, when it was first reached, and the rows adding to it.

    One row per group; a task sends at most one row per group to the last shuffle.
    """
    steps = load_steps(df, group, start, end, value)
    # The highest load, of equal ones the earliest.
    top = F.min_by(F.struct("load", "at", "active"), F.struct((-F.col("load")).alias("l"), "at")).alias("top")
    found = steps.groupBy(*group).agg(top)
    return found.select(*group, F.col("top.load").alias("peak"), F.col("top.at").alias("peak_at"), F.col("top.active").alias("active"))
