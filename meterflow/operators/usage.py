"""Usage profiles, totals and counts. All work on batch and streaming input."""

from pyspark.sql import functions as F

from ..checks import require_columns

MONTH = ("year", "month")


def profile(df, keys, measures):
    """Minimum, maximum and mean of each measure per key group."""
    require_columns(df, *keys, *measures)
    stats = {"min": F.min, "max": F.max, "avg": F.avg}
    aggs = [fn(m).alias(f"{name}_{m}") for m in measures for name, fn in stats.items()]
    return df.groupBy(*keys).agg(*aggs)


def total(df, keys, measure, name=None):
    """Sum of a measure per key group."""
    require_columns(df, *keys, measure)
    return df.groupBy(*keys).agg(F.sum(measure).alias(name or f"total_{measure}"))


def group_counts(df, keys, name="rows"):
    """Row count per key group."""
    require_columns(df, *keys)
    return df.groupBy(*keys).agg(F.count("*").alias(name))
