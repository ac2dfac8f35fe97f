"""The closest rows of a group by a value."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..checks import require_columns
from .ordered import ranked

BLOCK = 4096


def closest_k(df, group, key, value, k, block=BLOCK):
    """(group, key, value, place, near_key, near_value, gap): the ``k`` rows of the group closest by value.

    Rows are ordered by (value, key), which must be unique in a group; a
    row's closest are ordered by the gap of values, then by the number of places between, then the lower
    first. Exact for any ``k``: the places of all rows are computed over range
    slices, blocks of ``block`` places (``2 * k`` at least) take the ``k`` rows beside them as well, and every row
    finds its closest within its block. So a group spans many tasks and rows are copied once at
    most. Rows without a value have no neighbours and are nobody's.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    group = list(group)
    require_columns(df, *group, key, value)
    block = max(block, 2 * k)
    rows = ranked(df.select(*group, key, value).where(F.col(value).isNotNull()), group, [value, key], "__at")
    own = F.floor((F.col("__at") - 1) / block).cast("long")
    inside = F.pmod(F.col("__at") - 1, F.lit(block))
    # The first rows of a block are also seen by the block before, the last ones by the next.
    blocks = F.array_compact(F.array(own, F.when(inside < k, own - 1), F.when(inside >= block - k, own + 1)))
    copies = rows.withColumns({"__own": own, "__block": F.explode(blocks)}).where("__block >= 0")
    beside = Window.partitionBy(*group, "__block").orderBy("__at").rowsBetween(-k, k)
    near = F.collect_list(F.struct("__at", F.col(key).alias("k"), F.col(value).alias("v"))).over(beside)
    found = copies.withColumn("__near", near).where("__block = __own")

    def told(n):
        away = F.abs(n["__at"] - F.col("__at"))
        return F.struct(F.abs(n["v"] - F.col(value)).alias("gap"), away.alias("away"), n["__at"].alias("at"), n["k"].alias("k"), n["v"].alias("v"))

    others = F.filter("__near", lambda n: n["__at"] != F.col("__at"))
    best = F.slice(F.sort_array(F.transform(others, told)), 1, k)
    out = found.select(*group, key, value, F.posexplode(best).alias("place", "n"))
    return out.select(
        *group, key, value, (F.col("place") + 1).alias("place"), F.col("n.k").alias(f"near_{key}"), F.col("n.v").alias(f"near_{value}"), F.col("n.gap").alias("gap"),
    )
