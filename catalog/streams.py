"""Streaming runs over the events, and write/read-back of the sinks.

Each run works in a fresh folder under the shared checkpoint folder, takes the
whole table once and returns what it wrote.
"""

from pyspark.sql import functions as F

from meterflow.durable import work_dir
from meterflow.functions import keys
from meterflow.operators import enrich, latest, network
from meterflow.plans import live, monthly
from meterflow.sinks import files as sinks
from meterflow.sources import files as sources
from meterflow.streaming import runner, state

from .network import BASE_SQL
from .registry import ORACLES, query
from .tables import READINGS_SQL, as_readings, readings, table, transformers
from .usage import TIE, _latest_sql, _shown, enriched, household_ward_month_profile

# The columns of the monthly profile, fixed here so that no other plan is built for them.
PROFILE = [
    "household_id", "year", "month", "district", "ward", "min_electricity_usage_kwh", "max_electricity_usage_kwh",
    "avg_electricity_usage_kwh", "min_voltage", "max_voltage", "avg_voltage", "bucket_name",
]
PLACE_COLUMNS = ["house_number", "ward", "district", "city"]


def _event_stream(spark, sf_dir):
    # The glob also takes a table stored as one file.
    schema = table(spark, sf_dir, "events").schema
    return sources.file_stream(spark, f"{sf_dir}/events.parquet*", schema)


def _reading_stream(spark, sf_dir):
    """Enriched readings; places are a static lookup."""
    rows = as_readings(_event_stream(spark, sf_dir), spark, sf_dir)
    return enrich.enrich_household(rows, measure_type="double")


def messages_tasks(spark):
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _finish(query_run):
    runner.run_all([query_run])


@query("stream_latest_hour", _latest_sql("hour"))
def stream_latest_hour(spark, sf_dir):
    home = work_dir(spark, "stream_latest_hour")
    newest = state.latest_stream(_reading_stream(spark, sf_dir), ["device_id"], "hour", tiebreak=TIE)
    _finish(runner.run_batches(
        newest, sinks.write_latest_log, f"{home}/state", mode="update", available_now=True,
        bound={"path": f"{home}/log"},
    ))
    return _shown(sinks.read_latest_log(spark, f"{home}/log", "hour", tiebreak=TIE), "hour")


@query("stream_month_profile", ORACLES["household_ward_month_profile"])
def stream_month_profile(spark, sf_dir):
    home = work_dir(spark, "stream_month_profile")
    _finish(monthly.start(
        _reading_stream(spark, sf_dir), f"{home}/out", f"{home}/state", fmt="parquet", layout="folders", available_now=True,
    ))
    rows = spark.read.parquet(f"{home}/out").withColumns({
        "year": F.col("year").cast("int"), "month": F.col("month").cast("int"),
        **{c: F.round(c, 9) for c in ("avg_electricity_usage_kwh", "avg_voltage")},
    })
    return rows.select(*PROFILE)


@query("stream_month_profile_log", ORACLES["household_ward_month_profile"])
def stream_month_profile_log(spark, sf_dir):
    home = work_dir(spark, "stream_month_profile_log")
    _finish(monthly.start(
        _reading_stream(spark, sf_dir), f"{home}/out", f"{home}/state", layout="log", available_now=True,
    ))
    rows = monthly.read_profile_log(spark, f"{home}/out").withColumns({
        c: F.round(c, 9) for c in ("avg_electricity_usage_kwh", "avg_voltage")
    })
    return rows.select(*PROFILE)


@query("stream_raw_json", f"""
WITH {READINGS_SQL}
SELECT household_id, device_id, ward, electricity_usage_kwh, voltage, round("current", 9) AS "current",
       formatted_timestamp, date_part, "hour", "minute" FROM parts
""")
def stream_raw_json(spark, sf_dir):
    """Readings appended as JSON rows by ward and day, in their output columns."""
    home = work_dir(spark, "stream_raw_json")
    rows = enrich.project_for(_reading_stream(spark, sf_dir), "household", ["ward"])

    def append(batch, batch_id):
        sinks.write_batch(batch, batch_id, f"{home}/out", ["ward", "date_part"], "json")

    _finish(runner.run_batches(rows, append, f"{home}/state", available_now=True))
    back = sources.read_json(spark, f"{home}/out", rows.schema).withColumn("current", F.round("current", 9))
    return back.select(*rows.columns)


@query("stream_transformers", f"""
WITH {BASE_SQL}
SELECT r.reading_id, coalesce(t.transformer_id, 'Unknown_Transformer') AS transformer_id,
       strftime(r."timestamp", '%Y-%m-%d') AS day
FROM readings r LEFT JOIN transformers t ON r.district = t.district AND r.ward = t.ward
""")
def stream_transformers(spark, sf_dir):
    home = work_dir(spark, "stream_transformers")
    rows = network.assign_transformer(_reading_stream(spark, sf_dir), transformers(spark, sf_dir))
    rows = rows.select("reading_id", "transformer_id", F.col("date_part").alias("day"))

    def append(batch, batch_id):
        sinks.write_batch(batch, batch_id, f"{home}/out", ["day"])

    _finish(runner.run_batches(rows, append, f"{home}/state", available_now=True))
    out = spark.read.schema("reading_id long, transformer_id string, day string").parquet(f"{home}/out")
    return out.select("reading_id", "transformer_id", "day")


@query("stream_messages", f"""
WITH {READINGS_SQL}
SELECT device_id, formatted_timestamp, round(electricity_usage_kwh, 2) AS kwh, voltage, city
FROM parts JOIN events e ON e.event_id = reading_id
WHERE e.event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY device_id, date_part, "hour"
                           ORDER BY "timestamp" DESC, reading_id DESC) = 1
""")
def stream_messages(spark, sf_dir):
    """JSON messages, some of them broken, through the whole live plan."""
    home = work_dir(spark, "stream_messages")
    # Few, densely packed files hold the events: dealt anew, so that all cores make and parse messages.
    events = _event_stream(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    events = events.repartition(messages_tasks(spark))
    rows = as_readings(events, spark, sf_dir, keep=["event_type"])
    location = F.struct(*PLACE_COLUMNS).alias("location")
    fields = ["type", "household_id", "device_id", "timestamp", "electricity_usage_kwh", "voltage",
              "current", location, "price_per_kwh", "total_cost"]
    whole = F.to_json(F.struct(*fields), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("#"), whole)).otherwise(whole)
    messages = rows.select(broken.cast("binary").alias("value"))
    runner.run_all(live.start(
        {"household": messages}, f"{home}/out", f"{home}/state", available_now=True, interval=None,
    ))
    newest = sinks.read_latest_log(spark, f"{home}/out/household/hour", "hour")
    return newest.select(
        "device_id", "formatted_timestamp", F.round(F.col("electricity_usage_kwh").cast("double"), 2).alias("kwh"),
        "voltage", F.col("location.city").alias("city"),
    )


_ROWS_SQL = f"""
WITH {READINGS_SQL}
SELECT reading_id, household_id, ward, date_part, electricity_usage_kwh, voltage, formatted_timestamp
FROM parts
"""
_ROWS = ["reading_id", "household_id", "electricity_usage_kwh", "voltage", "formatted_timestamp", "ward", "date_part"]
_ROWS_SCHEMA = (
    "reading_id long, household_id string, electricity_usage_kwh double, voltage int, "
    "formatted_timestamp string, ward string, date_part string"
)


def _written(spark, sf_dir, fmt):
    path = work_dir(spark, f"rows_{fmt}")
    sinks.write_partitioned(enriched(spark, sf_dir).select(*_ROWS), path, ["ward", "date_part"], fmt)
    return path


@query("csv_read_back", _ROWS_SQL)
def csv_read_back(spark, sf_dir):
    return sources.read_delimited(spark, _written(spark, sf_dir, "csv"), schema=_ROWS_SCHEMA)


@query("json_read_back", _ROWS_SQL)
def json_read_back(spark, sf_dir):
    return sources.read_json(spark, _written(spark, sf_dir, "json"), _ROWS_SCHEMA)


@query("parquet_read_back", _ROWS_SQL)
def parquet_read_back(spark, sf_dir):
    return sources.read_parquet(spark, _written(spark, sf_dir, "parquet"), _ROWS_SCHEMA)


@query("text_read_back", f"""
WITH {READINGS_SQL}
SELECT concat_ws(',', household_id, voltage, formatted_timestamp, house_number, ward) AS value FROM parts
""")
def text_read_back(spark, sf_dir):
    path = work_dir(spark, "rows_text")
    rows = enriched(spark, sf_dir).select(
        "household_id", "voltage", "formatted_timestamp", F.struct("house_number", "ward").alias("location")
    )
    sinks.write_text_lines(rows, path)
    return sources.read_text(spark, path)


@query("profile_partitions", ORACLES["household_ward_month_profile"])
def profile_partitions(spark, sf_dir):
    """Monthly profiles written twice by key folder; the second run replaces the first."""
    path = work_dir(spark, "profile_partitions")
    rows = household_ward_month_profile(spark, sf_dir)
    for run in range(2):
        monthly.write_profiles(rows, run, path, fallback=f"{path}-fallback", fmt="parquet")
    kinds = {"bucket_name": "string", "year": "int", "month": "int"}
    return spark.read.parquet(path).withColumns({c: F.col(c).cast(k) for c, k in kinds.items()}).select(*rows.columns)


@query("latest_objects", f"""
WITH {READINGS_SQL}
SELECT concat(device_id, '/', date_part, '/', "hour", '.json') AS object_key, reading_id,
       electricity_usage_kwh, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS iso
FROM parts QUALIFY row_number() OVER (
  PARTITION BY device_id, date_part, "hour" ORDER BY "timestamp" DESC, reading_id DESC) = 1
""")
def latest_objects(spark, sf_dir):
    newest = latest.latest_at(readings(spark, sf_dir), ["device_id"], "hour", tiebreak=TIE)
    objects = sinks.latest_objects(enrich.add_time_parts(newest), "hour")
    fields = "reading_id long, electricity_usage_kwh double, timestamp string"
    return objects.select("object_key", F.from_json("json", fields).alias("d")).select(
        "object_key", "d.reading_id", "d.electricity_usage_kwh",
        F.substring("d.timestamp", 1, 19).alias("iso"),
    )


@query("stored_objects", f"""
WITH {READINGS_SQL} SELECT ward, count(DISTINCT date_part) AS days FROM parts GROUP BY ward
""")
def stored_objects(spark, sf_dir):
    """Folders per ward counted from a listing of the written files."""
    path = _written(spark, sf_dir, "parquet")
    listing = sources.list_objects(spark, path, "*.parquet")
    key = keys.key_of_path(F.regexp_replace("path", "^file:/+", "/"), f"{path}/".replace("file:", ""))
    folders = listing.select(
        F.regexp_extract(key, "ward=([^/]+)/date_part=([^/]+)/", 1).alias("ward"),
        F.regexp_extract(key, "ward=([^/]+)/date_part=([^/]+)/", 2).alias("date_part"),
    )
    return folders.groupBy("ward").agg(F.count_distinct("date_part").alias("days"))
