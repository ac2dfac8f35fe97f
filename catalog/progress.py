"""Progress and status tables over a batch log derived from the events."""

from pyspark.sql import functions as F

from meterflow.operators import progress

from .registry import query
from .tables import BATCH_LOG_SQL, batch_log, table


@query("batch_rates", f"""
WITH {BATCH_LOG_SQL}
SELECT "type", batch_id, records, duration_ms,
       round(CASE WHEN duration_ms > 0 THEN records / (duration_ms / 1000.0) ELSE 0 END, 6) AS processing_rate
FROM batch_log
""")
def batch_rates(spark, sf_dir):
    rows = progress.with_rates(batch_log(spark, sf_dir))
    return rows.select(
        "type", "batch_id", "records", "duration_ms", F.round("processing_rate", 6).alias("processing_rate")
    )


@query("batch_summary", f"""
WITH {BATCH_LOG_SQL},
per AS (
  SELECT "type", count(*) AS batches, CAST(sum(records) AS BIGINT) AS records,
         CAST(sum(duration_ms) AS BIGINT) AS duration_ms FROM batch_log GROUP BY "type"
  UNION ALL
  SELECT 'total', count(*), CAST(sum(records) AS BIGINT), CAST(sum(duration_ms) AS BIGINT) FROM batch_log)
SELECT *, round(CASE WHEN duration_ms > 0 THEN records / (duration_ms / 1000.0) ELSE 0 END, 6) AS throughput
FROM per
""")
def batch_summary(spark, sf_dir):
    rows = progress.summary(batch_log(spark, sf_dir))
    return rows.withColumn("throughput", F.round("throughput", 6))


@query("runtime_throughput", """
SELECT count(*) AS records, round(epoch_us(max(ts)) / 1000000.0 - epoch_us(min(ts)) / 1000000.0, 3) AS runtime_seconds,
       round(count(*) / (epoch_us(max(ts)) / 1000000.0 - epoch_us(min(ts)) / 1000000.0), 9) AS records_per_second
FROM events
""")
def runtime_throughput(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", F.lit(1).alias("records"))
    row = progress.runtime_throughput(events)
    return row.select(
        "records", F.round("runtime_seconds", 3).alias("runtime_seconds"),
        F.round("records_per_second", 9).alias("records_per_second"),
    )


@query("error_counts", """
SELECT event_type AS error_type, count(*) AS errors FROM events WHERE value > 400 GROUP BY event_type
UNION ALL SELECT 'total', count(*) FROM events WHERE value > 400
""")
def error_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return progress.error_counts(
        events.select(F.when(F.col("value") > 400, F.col("event_type")).alias("error_type"))
    )


@query("status_summary", """
SELECT count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS active_jobs,
       count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS completed_jobs,
       count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS failed_jobs FROM orders
""")
def status_summary(spark, sf_dir):
    state = F.col("o_orderstatus")
    jobs = table(spark, sf_dir, "orders").select(
        F.when(state == "O", progress.RUNNING).when(state == "F", progress.SUCCEEDED)
        .when(state == "P", progress.FAILED).alias("status")
    )
    return progress.status_summary(jobs)


@query("executor_summary", """
SELECT count(*) AS executor_count, CAST(sum(p_size) AS BIGINT) AS total_cores,
       round(sum(CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice ELSE 0 END), 2) AS memory_used,
       round(sum(p_retailprice), 2) AS memory_total,
       round(sum(CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice ELSE 0 END) / sum(p_retailprice) * 100, 6)
         AS memory_percent
FROM part
""")
def executor_summary(spark, sf_dir):
    executors = table(spark, sf_dir, "part").select(
        F.col("p_size").alias("totalCores"), F.col("p_retailprice").alias("maxMemory"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_retailprice")).alias("memoryUsed"),
    )
    return progress.executor_summary(executors).withColumns({
        "memory_used": F.round("memory_used", 2), "memory_total": F.round("memory_total", 2),
        "memory_percent": F.round("memory_percent", 6),
    })


@query("completed_batches", f"""
WITH {BATCH_LOG_SQL}
SELECT count(*) AS completed_batches, round(avg(duration_ms), 6) AS avg_processing_ms FROM batch_log
""")
def completed_batches(spark, sf_dir):
    row = progress.completed_batches(batch_log(spark, sf_dir))
    return row.withColumn("avg_processing_ms", F.round("avg_processing_ms", 6))


@query("prefix_counts", """
SELECT split_part(object_key, '-', 1) AS prefix, count(*) AS objects FROM (
  SELECT lower(concat(event_type, '-', user_id)) AS object_key FROM events) GROUP BY 1
""")
def prefix_counts(spark, sf_dir):
    listing = table(spark, sf_dir, "events").select(
        F.lower(F.concat_ws("-", "event_type", F.col("user_id").cast("string"))).alias("object_key")
    )
    return progress.prefix_counts(listing)
