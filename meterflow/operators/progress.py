"""Progress and status tables over batch logs (type, batch_id, ts, records, ...)."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..checks import require_columns

# Job states (fixed values).
RUNNING, SUCCEEDED, FAILED = "RUNNING", "SUCCEEDED", "FAILED"


def rate(records, millis):
    """Records per second; 0 when no time was spent."""
    return F.when(F.col(millis) > 0, F.col(records) / (F.col(millis) / 1000)).otherwise(F.lit(0.0))


def with_rates(log, records="records", millis="duration_ms", name="processing_rate"):
    require_columns(log, records, millis)
    return log.withColumn(name, rate(records, millis))


def summary(log, kind="type", records="records", millis="duration_ms"):
    """Batches, records, time and rate per type, and over all types."""
    require_columns(log, kind, records, millis)
    per_type = log.groupBy(kind).agg(
        F.count("*").alias("batches"), F.sum(records).alias("records"),
        F.sum(millis).alias("duration_ms"),
    )
    overall = per_type.agg(
        F.lit("total").alias(kind), F.sum("batches").alias("batches"),
        F.sum("records").alias("records"), F.sum("duration_ms").alias("duration_ms"),
    )
    return with_rates(per_type.unionByName(overall), "records", "duration_ms", "throughput")


def runtime_throughput(log, ts="ts", records="records"):
    """Total records, runtime from first to last batch, and records per second."""
    require_columns(log, ts, records)
    span = log.agg(
        F.sum(records).alias("records"),
        ((F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp")))
         / 1_000_000).alias("runtime_seconds"),
    )
    seconds = F.when(F.col("runtime_seconds") > 0, F.col("runtime_seconds")).otherwise(F.lit(1.0))
    return span.withColumn("records_per_second", F.col("records") / seconds)


def error_counts(log, kind="error_type"):
    """Errors per type, and over all types."""
    require_columns(log, kind)
    per_type = log.filter(F.col(kind).isNotNull()).groupBy(kind).agg(F.count("*").alias("errors"))
    overall = per_type.agg(
        F.lit("total").alias(kind), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors")
    )
    return per_type.unionByName(overall)


def status_summary(jobs, status="status"):
    """Job counts by state, in one row."""
    require_columns(jobs, status)
    state = F.col(status)
    return jobs.agg(
        F.count_if(state == RUNNING).alias("active_jobs"),
        F.count_if(state == SUCCEEDED).alias("completed_jobs"),
        F.count_if(state == FAILED).alias("failed_jobs"),
    )


def executor_summary(executors, cores="totalCores", used="memoryUsed", limit="maxMemory"):
    """Executors, cores, memory and memory share, with missing values as 0."""
    require_columns(executors, cores, used, limit)

    def added(column):
        return F.coalesce(F.sum(F.coalesce(column, F.lit(0))), F.lit(0))

    sums = executors.agg(
        F.count("*").alias("executor_count"), added(cores).alias("total_cores"),
        added(used).alias("memory_used"), added(limit).alias("memory_total"),
    )
    share = F.when(F.col("memory_total") > 0, F.col("memory_used") / F.col("memory_total") * 100)
    return sums.withColumn("memory_percent", share.otherwise(F.lit(0.0)))


def completed_batches(log, millis="duration_ms"):
    """Completed batches and their mean processing time."""
    require_columns(log, millis)
    return log.agg(
        F.count("*").alias("completed_batches"),
        F.coalesce(F.avg(millis), F.lit(0.0)).alias("avg_processing_ms"),
    )


def prefix_counts(listing, key="object_key", sep="-"):
    """Objects per key prefix (the key up to the first separator)."""
    require_columns(listing, key)
    return listing.groupBy(F.substring_index(key, sep, 1).alias("prefix")).agg(
        F.count("*").alias("objects")
    )


def observe_counts(df, required, name="counts"):
    """(df, observation) counting rows, valid and refused ones as ``df`` is written.

    Read ``observation.get`` after the first action; no extra pass is made.
    """
    from .decode import complete

    require_columns(df, *required)
    good = complete(required)
    observation = Observation(name)
    seen = df.observe(
        observation, F.count(F.lit(1)).alias("records"),
        F.count(F.when(good, 1)).alias("valid"), F.count(F.when(~good, 1)).alias("refused"),
    )
    return seen, observation
