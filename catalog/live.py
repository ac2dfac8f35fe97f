"""Streams over the events in rough time order: last rows, late rows, silence, running fits.

The events are written as one file per ``DAYS`` days, one after another; a
stream reads a file per batch. Every ``STRAY``-th event comes a file late.
"""

from pyspark.sql import functions as F

from meterflow.durable import work_dir
from meterflow.operators import regression
from meterflow.operators.latest import latest_per_group
from meterflow.sinks import files as sinks
from meterflow.sources import files as sources
from meterflow.streaming import history, late, runner, silence

from .batches import _events
from .ordered import WARD_FIT_SQL, shown_fit
from .registry import query
from .tables import READINGS_SQL, as_readings, table

DAYS, FILES, STRAY = 6, 5, 10
PART_SQL = f"""CAST(least({FILES - 1}, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // {DAYS} + CASE WHEN event_id % {STRAY} = 0 THEN 1 ELSE 0 END) AS INTEGER)"""


def _timely(spark, sf_dir, path, stray=True):
    """The events as a stream of files in time order, stray ones a file late."""
    events = table(spark, sf_dir, "events")
    part = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / DAYS).cast("int")
    if stray:
        part = part + (F.col("event_id") % STRAY == 0).cast("int")
    placed = events.withColumn("part", F.least(part, F.lit(FILES - 1)))
    for p in range(FILES):
        placed.where(F.col("part") == p).drop("part").coalesce(1).write.parquet(f"{path}/file{p}")
    return sources.file_stream(spark, f"{path}/*", events.schema, max_files=1)


@query("stream_last_n", f"""
WITH {READINGS_SQL}
SELECT ward, reading_id, "timestamp", electricity_usage_kwh, device_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY ward ORDER BY "timestamp" DESC, reading_id DESC) AS rank FROM readings)
WHERE rank <= 20
""")
def stream_last_n(spark, sf_dir):
    """The twenty newest readings of every ward over batches that come out of time order."""
    home = work_dir(spark, "stream_last_n")
    columns = ["ward", "reading_id", "timestamp", "electricity_usage_kwh", "device_id"]
    rows = as_readings(_events(spark, sf_dir, f"{home}/in"), spark, sf_dir).select(*columns)
    newest = history.last_n_stream(rows, ["ward"], 20, tiebreak="reading_id")

    def process(batch, batch_id):
        sinks.write_batch(batch, batch_id, f"{home}/out")

    runner.run_all([runner.run_batches(newest, process, f"{home}/state", mode="update", available_now=True)])
    return history.current_rows(spark.read.parquet(f"{home}/out"), ["ward"]).select(*columns, "rank")


_LATE_SQL = f"""
placed AS (SELECT *, {PART_SQL} AS part FROM events),
marks AS (SELECT part, max(ts) AS newest FROM placed GROUP BY part),
seen AS (SELECT p.part, max(m.newest) - INTERVAL 1 HOUR AS mark FROM (SELECT DISTINCT part FROM placed) p LEFT JOIN marks m ON m.part < p.part GROUP BY p.part),
judged AS (SELECT placed.*, mark, coalesce(ts < mark, false) AS late FROM placed JOIN seen USING (part))"""


def _late_run(spark, sf_dir, label):
    home = work_dir(spark, label)

    def keep(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{home}/kept/batch_id={batch_id}")

    runner.run_all([late.run_with_late(_timely(spark, sf_dir, f"{home}/in"), keep, home, f"{home}/state", "ts", "1 hour", available_now=True)])
    return home


@query("stream_late_rows", f"""
WITH {_LATE_SQL}
SELECT event_id, CAST(part AS BIGINT) AS batch_id, late, CASE WHEN late THEN mark END AS watermark FROM judged
""")
def stream_late_rows(spark, sf_dir):
    """Every event as the stream judged it: kept, or refused by which watermark."""
    home = _late_run(spark, sf_dir, "stream_late_rows")
    kept = spark.read.parquet(f"{home}/kept").select("event_id", "batch_id", F.lit(False).alias("late"), F.lit(None).cast("timestamp_ntz").alias("watermark"))
    refused = late.late_rows(spark, home).select("event_id", "batch_id", F.lit(True).alias("late"), "watermark")
    return kept.unionByName(refused).withColumn("batch_id", F.col("batch_id").cast("long"))


@query("stream_late_counts", f"""
WITH {_LATE_SQL}
SELECT CAST(part AS BIGINT) AS batch_id, count(*) AS records, count_if(NOT late) AS kept, count_if(late) AS late, any_value(mark) AS watermark
FROM judged GROUP BY part
""")
def stream_late_counts(spark, sf_dir):
    return late.late_counts(spark, _late_run(spark, sf_dir, "stream_late_counts"))


@query("stream_silence", f"""
WITH {READINGS_SQL},
steps AS (
  SELECT device_id, "timestamp" AS ts, lag("timestamp") OVER (PARTITION BY device_id ORDER BY "timestamp") AS before FROM readings),
flagged AS (SELECT *, CASE WHEN before IS NULL OR ts >= before + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM steps),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY device_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS spell FROM flagged),
spells AS (SELECT device_id, spell, min(ts) AS active_from, max(ts) AS active_to FROM numbered GROUP BY device_id, spell),
closed AS (SELECT * FROM spells WHERE active_to + INTERVAL 6 HOUR <= (SELECT max("timestamp") FROM readings) - INTERVAL 1 HOUR)
SELECT device_id, active_to AS silent_from, lead(active_from) OVER (PARTITION BY device_id ORDER BY active_from) AS silent_to FROM closed
""")
def stream_silence(spark, sf_dir):
    """When devices fell silent for six hours or more, and when they were back."""
    home = work_dir(spark, "stream_silence")
    rows = as_readings(_timely(spark, sf_dir, f"{home}/in", stray=False), spark, sf_dir).select("device_id", "timestamp")
    spells = silence.active_spells(rows, ["device_id"], limit="6 hours", delay="1 hour")

    def process(batch, batch_id):
        sinks.write_batch(batch, batch_id, f"{home}/out")

    runner.run_all([runner.run_batches(spells, process, f"{home}/state", stateful=True, available_now=True)])
    return silence.silent_spells(spark.read.parquet(f"{home}/out"), ["device_id"])


@query("stream_ward_fit", f"WITH {READINGS_SQL},{WARD_FIT_SQL}")
def stream_ward_fit(spark, sf_dir):
    """One fit per ward as running state: the last report of each."""
    home = work_dir(spark, "stream_ward_fit")
    rows = as_readings(_events(spark, sf_dir, f"{home}/in"), spark, sf_dir).withColumn("hour", F.hour("timestamp"))
    fits = regression.grouped_fit(rows, ["ward"], ["voltage", "hour"], "electricity_usage_kwh")

    def process(batch, batch_id):
        sinks.write_batch(batch, batch_id, f"{home}/out")

    runner.run_all([runner.run_batches(fits, process, f"{home}/state", mode="update", available_now=True)])
    return shown_fit(latest_per_group(spark.read.parquet(f"{home}/out"), ["ward"], "batch_id"))
