"""Streams that take the events in several batches, out of time order.

The events are first written in several parts by a hash of their id; a stream reads
about a part per batch, so every batch but the first brings late rows. However many
files a part takes, the number of batches stays below twice that of parts.
"""

from pyspark.sql import functions as F

from meterflow.durable import work_dir
from meterflow.operators import enrich
from meterflow.operators.latest import latest_per_group
from meterflow.operators.progress import summary
from meterflow.plans import live, monthly
from meterflow.sinks import files as sinks
from meterflow.sources import files as sources
from meterflow.streaming import runner, state
from meterflow.streaming.progress import ProgressLog

from .registry import ORACLES, query
from .scalar import _messages
from .streams import PROFILE
from .tables import AREA_SQL, READINGS_SQL, area_totals, as_readings, table
from .usage import TIE, _latest_sql, _shown

FILES = 5


def _write(rows, path, key, parts=range(FILES)):
    """The rows of some of the parts, a folder each."""
    part = F.pmod(F.xxhash64(key), F.lit(FILES)).cast("int")
    rows = rows.withColumn("part", part).filter(F.col("part").isin(list(parts)))
    sinks.write_partitioned(rows, path, ["part"])


def _stream(spark, path, schema, parts=FILES):
    """What lies at ``path`` in at least as many batches as parts (a file each where there are fewer files)."""
    files = len(spark.read.schema(schema).parquet(path).inputFiles())
    return sources.file_stream(spark, path, schema, max_files=max(1, files // parts)).drop("part")


def _events(spark, sf_dir, path, parts=range(FILES)):
    events = table(spark, sf_dir, "events")
    _write(events, path, "event_id", parts)
    return _stream(spark, path, events.schema, len(parts))


def _enriched(events, spark, sf_dir):
    return enrich.enrich_household(as_readings(events, spark, sf_dir), measure_type="double")


@query("stream_late_latest", _latest_sql("hour"))
def stream_late_latest(spark, sf_dir):
    """Latest rows over late batches, the log folded in between and at the end."""
    home = work_dir(spark, "stream_late_latest")
    rows = _enriched(_events(spark, sf_dir, f"{home}/in"), spark, sf_dir)
    newest = state.latest_stream(rows, ["device_id"], "hour", tiebreak=TIE, expire_after="3650 days")

    def process(batch, batch_id):
        sinks.write_latest_log(batch, batch_id, f"{home}/log")
        if batch_id == 2:
            sinks.compact_latest_log(spark, f"{home}/log", "hour", tiebreak=TIE)

    # A row of state for every device and hour: more than the workers' memory.
    runner.run_all([runner.run_batches(newest, process, f"{home}/state", mode="update", available_now=True, state_on_disk=True)])
    sinks.compact_latest_log(spark, f"{home}/log", "hour", tiebreak=TIE)
    # Folded to the end: every row of the log is current.
    return _shown(spark.read.parquet(f"{home}/log").drop("log_day", "log_batch"), "hour")


@query("stream_restart", ORACLES["household_ward_month_profile"])
def stream_restart(spark, sf_dir):
    """Monthly profiles of a stream that fails once, is run again, stops half-way and goes on."""
    home = work_dir(spark, "stream_restart")
    rows = _enriched(_events(spark, sf_dir, f"{home}/in", range(3)), spark, sf_dir)
    profile = enrich.with_month_key(state.running_profile(rows, monthly.HOUSEHOLD_WARD_MONTH, monthly.MEASURES))
    failures = []

    def process(batch, batch_id):
        monthly.write_profile_log(batch, batch_id, f"{home}/out")
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("the store went away after the write")

    def run():
        runner.run_all([runner.run_batches(profile, process, f"{home}/state", mode="update", available_now=True)])

    try:
        run()
    except Exception:
        if not failures:
            raise
    run()
    _write(table(spark, sf_dir, "events"), f"{home}/in", "event_id", range(3, FILES))
    run()
    monthly.compact_profile_log(spark, f"{home}/out")
    found = spark.read.parquet(f"{home}/out").withColumns({
        "year": F.col("year").cast("int"), "month": F.col("month").cast("int"),
        **{c: F.round(c, 9) for c in ("avg_electricity_usage_kwh", "avg_voltage")},
    })
    return found.select(*PROFILE)


@query("stream_fallback", ORACLES["household_ward_month_profile"])
def stream_fallback(spark, sf_dir):
    """Profiles of a stream whose store does not exist: every batch lands in the fallback."""
    home = work_dir(spark, "stream_fallback")
    rows = _enriched(_events(spark, sf_dir, f"{home}/in"), spark, sf_dir)
    runner.run_all([monthly.start(
        rows, "nostore://nowhere/out", f"{home}/state", fallback=f"{home}/spare", layout="log", available_now=True,
    )])
    found = monthly.read_profile_log(spark, f"{home}/spare").withColumns({
        "year": F.col("year").cast("int"), "month": F.col("month").cast("int"),
        **{c: F.round(c, 9) for c in ("avg_electricity_usage_kwh", "avg_voltage")},
    })
    return found.select(*PROFILE)


@query("stream_district_total", f"""
WITH {READINGS_SQL}
SELECT district, "year", "month", round(sum(electricity_usage_kwh), 4) AS total FROM parts GROUP BY ALL
""")
def stream_district_total(spark, sf_dir):
    """Running district totals: the last report of each district and month."""
    home = work_dir(spark, "stream_district_total")
    rows = _enriched(_events(spark, sf_dir, f"{home}/in"), spark, sf_dir)
    total = state.running_total(rows, monthly.DISTRICT_MONTH, "electricity_usage_kwh", "total")

    def process(batch, batch_id):
        sinks.write_batch(batch, batch_id, f"{home}/out")

    runner.run_all([runner.run_batches(total, process, f"{home}/state", mode="update", available_now=True)])
    last = latest_per_group(spark.read.parquet(f"{home}/out"), monthly.DISTRICT_MONTH, "batch_id")
    return last.select(*monthly.DISTRICT_MONTH, F.round("total", 4).alias("total"))


def _message_streams(spark, sf_dir, home):
    """Household and area messages, some of either broken, each in several files."""
    _write(_messages(spark, sf_dir), f"{home}/in/household", "reading_id")
    area = area_totals(spark, sf_dir)
    text = F.to_json(F.struct(*area.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"})
    text = F.when(F.minute("timestamp") % 10 == 0, F.concat(F.lit("#"), text)).otherwise(text)
    _write(area.select("timestamp", text.cast("binary").alias("value")), f"{home}/in/area", "timestamp")
    return {
        "household": _stream(spark, f"{home}/in/household", "reading_id long, value binary, part int").select("value"),
        "area": _stream(spark, f"{home}/in/area", "timestamp timestamp_ntz, value binary, part int").select("value"),
    }


def _kind_counts(name, rows, good):
    slots = {"minute": "minute", "hour": "hour", "day": "day"}
    counted = ", ".join(
        f"count(DISTINCT CASE WHEN {good} THEN concat(device_id, date_trunc('{unit}', \"timestamp\")) END) AS {grain}_rows"
        for grain, unit in slots.items()
    )
    return f"""
SELECT '{name}' AS kind, count(*) AS records, count_if({good}) AS valid, count_if(NOT ({good})) AS refused,
       {counted}, count_if(NOT ({good})) AS quarantined FROM {rows}"""


@query("stream_two_kinds", f"""
WITH {AREA_SQL}
{_kind_counts("household", "(SELECT r.*, e.event_type FROM readings r JOIN events e ON e.event_id = r.reading_id)", "event_type <> 'error'")}
UNION ALL
{_kind_counts("area", "area", """minute("timestamp") % 10 <> 0""")}
""")
def stream_two_kinds(spark, sf_dir):
    """Household and area messages through the live plan at once: what each output holds."""
    home = work_dir(spark, "stream_two_kinds")
    runner.run_all(live.start(
        _message_streams(spark, sf_dir, home), f"{home}/out", f"{home}/state", available_now=True, interval=None,
    ))
    found = spark.read.parquet(f"{home}/out/progress").groupBy(F.col("type").alias("kind")).agg(
        *[F.sum(c).alias(c) for c in ("records", "valid", "refused")]
    )
    for grain in ("minute", "hour", "day"):
        counts = None
        for kind in ("household", "area"):
            rows = sinks.read_latest_log(spark, f"{home}/out/{kind}/{grain}", grain)
            one = rows.agg(F.lit(kind).alias("kind"), F.count("*").alias(f"{grain}_rows"))
            counts = one if counts is None else counts.unionByName(one)
        found = found.join(counts, "kind")
    bad = None
    for kind in ("household", "area"):
        rows = spark.read.schema("raw string").parquet(f"{home}/out/quarantine/{kind}")
        one = rows.agg(F.lit(kind).alias("kind"), F.count("*").alias("quarantined"))
        bad = one if bad is None else bad.unionByName(one)
    return found.join(bad, "kind")


@query("stream_progress", f"""
WITH {AREA_SQL},
per AS (
  SELECT 'events_read' AS "type", count(*) AS records FROM events
  UNION ALL SELECT 'areas_read', count(*) FROM area)
SELECT "type", CAST(records AS BIGINT) AS records, true AS several FROM per
UNION ALL SELECT 'total', CAST(sum(records) AS BIGINT), true FROM per
""")
def stream_progress(spark, sf_dir):
    """Totals of the progress table of two streams, written in pieces of two rows."""
    home = work_dir(spark, "stream_progress")
    area = area_totals(spark, sf_dir)
    _write(area, f"{home}/in/area", "timestamp")
    streams = {
        "events_read": _events(spark, sf_dir, f"{home}/in/events"), "areas_read": _stream(spark, f"{home}/in/area", area.schema),
    }
    log = ProgressLog(spark, f"{home}/progress", flush_rows=2)
    spark.streams.addListener(log)
    try:
        runs = [
            runner.run_batches(rows, lambda batch, batch_id: batch.write.format("noop").mode("append").save(), f"{home}/{name}",
                               name=name, available_now=True, stateful=True)
            for name, rows in streams.items()
        ]
        runner.run_all(runs)
        log.wait_for(runs)
    finally:
        spark.streams.removeListener(log)
    return summary(log.table()).select("type", "records", (F.col("batches") > 2).alias("several"))
