"""Neighbouring rows, running sums and ranks in a sorted group, for groups too large for one task."""

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..checks import require_columns
from ..durable import durable


def _sliced(df, group, order):
    """``df`` range partitioned over group and order, with the number of each row's slice.

    A large group spans many slices. Stored once: all steps that follow have to see
    the same slices.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return durable(df.repartitionByRange(parts, *group, *order).withColumn("__slice", F.spark_partition_id()))


def _inside(group, order):
    return Window.partitionBy(*group, "__slice").orderBy(*order)


def _across(group):
    """The slices of a group in order; as many rows per group as it has slices."""
    return Window.partitionBy(*group).orderBy("__slice")


def _with_slices(rows, slices, group):
    """``rows`` with what is known of their slice. Null group values form a group like any other."""
    keys = [*group, "__slice"]
    slices = slices.withColumnsRenamed({k: f"{k}__of" for k in keys})
    same = [rows[k].eqNullSafe(slices[f"{k}__of"]) for k in keys]
    return rows.join(slices, reduce(and_, same)).drop(*[f"{k}__of" for k in keys])


def with_next(df, group, order, columns, prefix="next_"):
    """Each row with the given columns of the row after it in its group.

    ``order`` must be unique within a group and not null. Each slice is linked in
    itself and its last row takes the first row of the next slice. Only one row
    per slice and group meets in the second step.
    """
    group, order, columns = list(group), list(order), list(columns)
    require_columns(df, *group, *order, *columns)
    sliced = _sliced(df, group, order)
    ahead = F.struct(*[F.col(c).alias(f"{prefix}{c}") for c in columns])
    linked = sliced.withColumn("__ahead", F.lead(ahead).over(_inside(group, order)))
    firsts = sliced.groupBy(*group, "__slice").agg(F.min_by(ahead, F.struct(*order)).alias("__first"))
    firsts = firsts.withColumn("__first", F.lead("__first").over(_across(group)))
    out = _with_slices(linked, firsts, group).withColumn("__ahead", F.coalesce("__ahead", "__first"))
    return out.select(*df.columns, "__ahead.*")


def running_sums(df, group, order, sums):
    """Each row with sums over its group up to and including it: ``{new column: column}``.

    ``order`` must be unique within a group. Slices are summed in themselves; the
    totals of the slices before are carried in. Nulls count as nothing. Sums of whole
    numbers and decimals are exact; those of doubles depend on the slices in their last digits.
    """
    group, order = list(group), list(order)
    require_columns(df, *group, *order, *sums.values())
    sliced = _sliced(df, group, order)
    so_far = _inside(group, order).rowsBetween(Window.unboundedPreceding, 0)
    before = _across(group).rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumns({f"__own_{name}": F.coalesce(F.sum(c).over(so_far), F.lit(0)) for name, c in sums.items()})
    totals = sliced.groupBy(*group, "__slice").agg(*[F.sum(c).alias(f"__total_{name}") for name, c in sums.items()])
    carried = totals.select(*group, "__slice", *[F.coalesce(F.sum(f"__total_{n}").over(before), F.lit(0)).alias(f"__carried_{n}") for n in sums])
    out = _with_slices(own, carried, group)
    return out.select(*df.columns, *[(F.col(f"__own_{n}") + F.col(f"__carried_{n}")).alias(n) for n in sums])


def ranked(df, group, order, rank="rank"):
    """Each row with its exact place in its group, from 1; without a group, in the whole table.

    ``order`` must be unique within a group.
    """
    return running_sums(df.withColumn("__one", F.lit(1).cast("long")), group, order, {rank: "__one"}).drop("__one")


def carried_last(df, group, order, columns, prefix="last_"):
    """Each row with the last known (not null) values of some columns up to and including it.

    ``order`` must be unique within a group. Columns are carried each on its own.
    """
    group, order, columns = list(group), list(order), list(columns)
    require_columns(df, *group, *order, *columns)
    sliced = _sliced(df, group, order)
    so_far = _inside(group, order).rowsBetween(Window.unboundedPreceding, 0)
    before = _across(group).rowsBetween(Window.unboundedPreceding, -1)
    own = sliced.withColumns({f"__own_{c}": F.last(c, ignorenulls=True).over(so_far) for c in columns})
    ends = sliced.groupBy(*group, "__slice").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"__end_{c}") for c in columns
    ])
    carried = ends.select(*group, "__slice", *[F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__carried_{c}") for c in columns])
    out = _with_slices(own, carried, group)
    return out.select(*df.columns, *[F.coalesce(f"__own_{c}", f"__carried_{c}").alias(f"{prefix}{c}") for c in columns])
