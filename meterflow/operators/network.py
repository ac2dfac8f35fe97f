"""Households and the transformers that feed them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import require_columns
from ..skew import join_dimension
from .latest import latest_per_group
from .ordered import with_next

PLACE = ("district", "ward")
# Fixed value: the name that stands for no known transformer.
UNKNOWN = "Unknown_Transformer"


def connect(readings, transformers, household="household_id", transformer="transformer_id", on=PLACE):
    """Supply edges: one per reading whose place has a transformer, available."""
    require_columns(readings, household, *on)
    require_columns(transformers, transformer, *on)
    joined = join_dimension(readings.select(household, *on), transformers.select(transformer, *on), on)
    return joined.select(
        F.col(household).alias("src"),
        F.col(transformer).alias("dst"),
        F.lit(1).alias("availability"),
    )


def assign_transformer(df, mapping, default=UNKNOWN, transformer="transformer_id", on=PLACE):
    """Rows with the transformer of their place, or a default name.

    Of several transformers of a place the one with the smallest id counts, so
    no row is repeated. Works on streaming ``df`` with a static mapping.
    """
    require_columns(mapping, transformer, *on)
    single = mapping.groupBy(*on).agg(F.min(transformer).alias(transformer))
    joined = join_dimension(df, single, on, "left")
    return joined.withColumn(transformer, F.coalesce(transformer, F.lit(default))).select(
        *df.columns, transformer
    )


def availability(df, voltage="voltage", name="availability"):
    """Supply flag: 1 with positive voltage, 0 without, null when unknown."""
    require_columns(df, voltage)
    flag = F.when(F.col(voltage) > 0, 1).when(F.col(voltage).isNotNull(), 0)
    return df.withColumn(name, flag)


def neighbour_edges(readings, household="household_id", usage="electricity_usage_kwh",
                    ts="timestamp", tiebreak=(), on=PLACE):
    """Edges between households of one ward, weighted by usage difference.

    Every household links to the next higher user of its ward (by its latest
    reading). These edges are a minimum spanning tree of the ward's complete
    neighbour graph: the same components and the same closest neighbours, with
    one edge per household instead of one per pair. Households without a known
    ward or usage have no neighbours.
    """
    require_columns(readings, household, usage, ts, *on)
    columns = list(dict.fromkeys([household, *on, usage, ts, *tiebreak]))
    newest = latest_per_group(readings.select(*columns), [household], ts, tiebreak)
    newest = newest.dropna(subset=[usage, *on]).select(household, *on, usage)
    linked = with_next(newest, on, [usage, household], [household, usage])
    linked = linked.filter(F.col(f"next_{household}").isNotNull())
    return linked.select(
        F.least(household, f"next_{household}").alias("src"),
        F.greatest(household, f"next_{household}").alias("dst"),
        (F.col(f"next_{usage}") - F.col(usage)).alias("usage_diff"),
    )


def vertices(readings, transformers, household="household_id", transformer="transformer_id"):
    """Distinct vertex ids of households and transformers."""
    ours = readings.select(F.col(household).alias("id"))
    return ours.unionByName(transformers.select(F.col(transformer).alias("id"))).distinct()


def combine_vertices(households, transformers, household="household_id", transformer="transformer_id"):
    """Vertices with their attributes; columns one side lacks are null there."""
    ours = households.withColumnRenamed(household, "id")
    theirs = transformers.withColumnRenamed(transformer, "id")
    return ours.unionByName(theirs, allowMissingColumns=True)


def simulate_failure(edges, failed_ids, dst="dst", flag="availability"):
    """Edges with the supply of the failed transformers switched off.

    ``failed_ids`` is a short list, or for outages of any size a DataFrame
    whose first column holds the ids.
    """
    require_columns(edges, dst, flag)
    if isinstance(failed_ids, DataFrame):
        listed = failed_ids.select(F.col(failed_ids.columns[0]).alias(dst)).distinct()
        marked = join_dimension(edges, listed.withColumn("__failed", F.lit(True)), [dst], "left")
        off = F.when(F.col("__failed"), 0).otherwise(F.col(flag))
        return marked.withColumn(flag, off).select(*edges.columns)
    failed = F.col(dst).isin(list(failed_ids))
    return edges.withColumn(flag, F.when(failed, 0).otherwise(F.col(flag)))


def supply_summary(edges, src="src", flag="availability"):
    """Households in total and with supply, counted once each, in one pass."""
    require_columns(edges, src, flag)
    per_household = edges.filter(F.col(src).isNotNull()).groupBy(src).agg(F.max(flag).alias("on"))
    return per_household.agg(
        F.count("*").alias("total_households"),
        F.count_if(F.col("on") == 1).alias("supplied_households"),
    )


def transformer_load(df, transformer="transformer_id", household="household_id",
                     usage="electricity_usage_kwh"):
    """Usage, readings and households per transformer, to find overloaded ones."""
    require_columns(df, transformer, household, usage)
    # First per household, so a transformer with most of the rows is already
    # reduced to its households before its own group is formed.
    each = df.groupBy(transformer, household).agg(
        F.sum(usage).alias("__usage"), F.count("*").alias("__rows")
    )
    return each.groupBy(transformer).agg(
        F.sum("__usage").alias("total_usage"),
        F.sum("__rows").alias("readings"),
        F.count(household).alias("households"),
    )
