"""Decoding, time parts, keys, cleaning and filters."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from meterflow.functions import keys, text, timeparts
from meterflow.operators import clean, decode, encode, enrich, features, filters, network, regression
from meterflow.schemas import HOUSEHOLD, widened

from .registry import query
from .tables import AREA_SQL, READINGS_SQL, area_totals, as_readings, readings, table

PROPS = StructType([StructField("k", IntegerType(), True)])


def _messages(spark, sf_dir):
    """Readings as JSON messages in bytes; those of error events are cut short."""
    rows = as_readings(table(spark, sf_dir, "events"), spark, sf_dir, keep=["event_type"])
    location = F.struct("house_number", "ward", "district", "city").alias("location")
    names = [f.name for f in HOUSEHOLD.fields if f.name != "location"]
    whole = F.to_json(
        F.struct(*names[:7], location, *names[7:]),
        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    cut = F.when(F.col("event_type") == "error", F.concat(F.lit("#"), whole)).otherwise(whole)
    return rows.select("reading_id", cut.cast("binary").alias("value"))


@query("decode_props_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def decode_props_json(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    as_bytes = events.select("event_id", F.col("props").cast("binary").alias("value"))
    return decode.decode_json(as_bytes, PROPS, keep=["event_id"])


@query("decode_readings", f"""
WITH {READINGS_SQL}
SELECT r.reading_id, r.household_id, r.device_id,
       strftime(r."timestamp", '%Y-%m-%d %H-%M-%S') AS formatted_timestamp,
       r.electricity_usage_kwh, r.voltage, r.house_number, r.ward, r.district, r.city, r.total_cost
FROM readings r JOIN events e ON e.event_id = r.reading_id
WHERE e.event_type <> 'error'
""")
def decode_readings(spark, sf_dir):
    rows = decode.decode_json(_messages(spark, sf_dir), widened(HOUSEHOLD), keep=["reading_id"], corrupt="raw")
    valid, _ = decode.split_valid(rows, ["household_id", "timestamp"], corrupt="raw")
    flat = decode.flatten_location(valid)
    return flat.withColumn("formatted_timestamp", timeparts.stamp("timestamp")).select(
        "reading_id", "household_id", "device_id", "formatted_timestamp", "electricity_usage_kwh",
        "voltage", "house_number", "ward", "district", "city", "total_cost",
    )


@query("quarantine_readings", """
SELECT event_id AS reading_id, 'malformed' AS quarantine_reason
FROM events WHERE event_type = 'error'
""")
def quarantine_readings(spark, sf_dir):
    rows = decode.decode_json(_messages(spark, sf_dir), widened(HOUSEHOLD), keep=["reading_id"], corrupt="raw")
    _, bad = decode.split_valid(rows, ["household_id", "timestamp"], corrupt="raw")
    return bad.select("reading_id", "quarantine_reason")


@query("partly_bad_readings", f"""
WITH {READINGS_SQL}
SELECT reading_id, CASE WHEN reading_id % 5 <> 0 THEN voltage END AS voltage, household_id, total_cost
FROM readings JOIN events e ON e.event_id = reading_id WHERE e.event_type <> 'error'
""")
def partly_bad_readings(spark, sf_dir):
    """A record with one bad optional field is kept with that field null."""
    spoilt = F.regexp_replace(F.col("value").cast("string"), '"voltage":[0-9]+', '"voltage":"high"')
    value = F.when(F.col("reading_id") % 5 == 0, spoilt.cast("binary")).otherwise(F.col("value"))
    rows = _messages(spark, sf_dir).withColumn("value", value)
    rows = decode.decode_json(rows, widened(HOUSEHOLD), keep=["reading_id"], corrupt="raw")
    valid, _ = decode.split_valid(rows, ["household_id", "timestamp"], corrupt="raw")
    return valid.select("reading_id", "voltage", "household_id", "total_cost")


@query("area_projection", f"""
WITH {AREA_SQL}
SELECT device_id, ward, round(total_electricity_usage_kwh, 6) AS kwh,
       strftime("timestamp", '%Y-%m-%d %H-%M-%S') AS formatted_timestamp, strftime("timestamp", '%Y-%m-%d') AS date_part,
       CAST(hour("timestamp") AS INTEGER) AS "hour", CAST(minute("timestamp") AS INTEGER) AS "minute"
FROM area
""")
def area_projection(spark, sf_dir):
    rows = enrich.enrich_area(area_totals(spark, sf_dir), measure_type="double")
    out = enrich.project_for(rows, "area", ["ward"])
    return out.withColumn("kwh", F.round("total_electricity_usage_kwh", 6)).drop("total_electricity_usage_kwh")


@query("required_fields", """
SELECT event_id, CASE WHEN event_type <> 'view' AND value <= 400 THEN 'valid'
       ELSE concat_ws(',', CASE WHEN event_type = 'view' THEN 'event_type' END,
                           CASE WHEN value > 400 THEN 'value' END) END AS verdict
FROM events
""")
def required_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("value") <= 400, F.col("value")).alias("value"),
    )
    marked = decode.mark_valid(events, ["event_type", "value"])
    return marked.select("event_id", F.coalesce("quarantine_reason", F.lit("valid")).alias("verdict"))


@query("time_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month",
       CAST(hour(ts) AS INTEGER) AS "hour", CAST(minute(ts) AS INTEGER) AS "minute"
FROM events
""")
def time_parts(spark, sf_dir):
    return enrich.add_time_parts(table(spark, sf_dir, "events"), "ts").select(
        "event_id", "year", "month", "hour", "minute"
    )


@query("day_and_stamp", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_part,
       strftime(ts, '%Y-%m-%d %H-%M-%S') AS stamp, strftime(ts, '%Y-%m-%d %H-%M') AS minute_stamp,
       translate(strftime(ts, '%Y-%m-%d %H:%M:%S'), ': ', '--') AS safe_stamp,
       split_part(strftime(ts, '%Y-%m-%d %H-%M-%S'), ' ', 1) AS stamp_day
FROM events
""")
def day_and_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", timeparts.day_text("ts").alias("date_part"), timeparts.stamp("ts").alias("stamp"),
        timeparts.stamp("ts", "minute").alias("minute_stamp"),
        timeparts.path_safe(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("safe_stamp"),
        timeparts.day_of_stamp(timeparts.stamp("ts")).alias("stamp_day"),
    )


@query("iso_stamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def iso_stamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", timeparts.iso_text("ts").alias("iso"))


@query("parse_date", """
SELECT o_orderkey, TRY_STRPTIME(t, '%m-%d-%Y')::DATE AS parsed FROM (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'no date'
                          ELSE strftime(o_orderdate, '%m-%d-%Y') END AS t FROM orders)
""")
def parse_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    shown = F.when(F.col("o_orderstatus") == "P", "no date").otherwise(
        F.date_format("o_orderdate", "MM-dd-yyyy")
    )
    return orders.select("o_orderkey", timeparts.parse_date(shown).alias("parsed"))


@query("location_key", f"""
WITH {READINGS_SQL}
SELECT reading_id, lower(concat(replace(city, ' ', '-'), '-', replace(ward, ' ', '-'), '-',
       replace(house_number, ' ', '-'))) AS bucket_name FROM readings
""")
def location_key(spark, sf_dir):
    # The city takes the district's place: its names hold blanks.
    rows = enrich.with_location_key(readings(spark, sf_dir), district="city")
    return rows.select("reading_id", "bucket_name")


@query("month_key", f"""
WITH {READINGS_SQL}
SELECT DISTINCT "year", "month", district, ward,
       lower(concat(replace(district, ' ', '-'), '-', replace(ward, ' ', '-'), '-',
             CAST("year" AS VARCHAR), '-', CAST("month" AS VARCHAR))) AS bucket_name FROM parts
""")
def month_key(spark, sf_dir):
    rows = enrich.add_time_parts(readings(spark, sf_dir))
    return enrich.with_month_key(filters.distinct_keys(rows, "year", "month", "district", "ward"))


@query("device_key", f"""
WITH {READINGS_SQL}
SELECT reading_id, lower(concat(city, '-', district, '-', house_number)) AS household_key,
       CAST(NULL AS VARCHAR) AS other_key FROM readings
""")
def device_key(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "reading_id", keys.household_key("device_id").alias("household_key"),
        keys.household_key("household_id").alias("other_key"),
    )


@query("area_key", f"""
WITH {AREA_SQL}
SELECT ward, district, city, strftime("timestamp", '%Y-%m-%d %H-%M-%S') AS formatted_timestamp,
       lower(concat(city, '-', district)) AS bucket_name,
       CAST(hour("timestamp") AS INTEGER) AS "hour",
       round(total_electricity_usage_kwh, 6) AS total_kwh
FROM area
""")
def area_key(spark, sf_dir):
    rows = enrich.enrich_area(area_totals(spark, sf_dir), measure_type="double")
    return rows.select(
        "ward", "district", "city", "formatted_timestamp", "bucket_name", "hour",
        F.round("total_electricity_usage_kwh", 6).alias("total_kwh"),
    )


@query("csv_line", """
SELECT event_id, concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type,
       CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y-%m-%d %H-%M-%S') END) AS line
FROM events
""")
def csv_line(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "stamp", F.when(F.col("event_type") != "view", timeparts.stamp("ts"))
    )
    line = text.delimited_line(["event_id", "user_id", "event_type", "stamp"])
    return events.select("event_id", line.alias("line"))


@query("object_keys", f"""
WITH {READINGS_SQL}
SELECT reading_id,
       concat(device_id, '/', date_part, '/', "hour", '/', "minute", '.json') AS minute_key,
       concat(device_id, '/', date_part, '/', "hour", '.json') AS hour_key,
       concat(device_id, '/', date_part, '.json') AS day_key,
       concat("type", '/', device_id, '/', city, '/', district, '/', date_part, '/', "hour", '/',
              "minute", '.json') AS deep_key
FROM parts
""")
def object_keys(spark, sf_dir):
    rows = enrich.add_time_parts(readings(spark, sf_dir))
    slot = ["date_part", "hour", "minute"]
    return rows.select(
        "reading_id", keys.object_key("device_id", *slot).alias("minute_key"),
        keys.object_key("device_id", *slot[:2]).alias("hour_key"),
        keys.object_key("device_id", *slot[:1]).alias("day_key"),
        keys.object_key("type", "device_id", "city", "district", *slot).alias("deep_key"),
    )


@query("path_key", """
SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN substr(url, 8) END AS object_key FROM pages
""")
def path_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", keys.key_of_path("url", "http://").alias("object_key")
    )


@query("to_numeric", """
SELECT doc_id, TRY_CAST(shown AS FLOAT) AS shown FROM (
  SELECT doc_id, CASE WHEN lang = 'en' THEN '?' ELSE CAST(n_chars AS VARCHAR) END AS shown
  FROM documents)
""")
def to_numeric(spark, sf_dir):
    shown = F.when(F.col("lang") == "en", "?").otherwise(F.col("n_chars").cast("string"))
    rows = table(spark, sf_dir, "documents").select("doc_id", shown.alias("shown"))
    return clean.to_numeric(rows, ["shown"])


_GAPS = """
SELECT event_id, nullif(event_type, 'view') AS event_type,
       CASE WHEN value <= 400 THEN value END AS value FROM events"""


def _with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("value") <= 400, F.col("value")).alias("value"),
    )


@query("null_counts", f"""
WITH g AS ({_GAPS})
SELECT 'event_id' AS column_name, count(*) - count(event_id) AS null_rows, count(event_id) AS set_rows FROM g
UNION ALL SELECT 'event_type', count(*) - count(event_type), count(event_type) FROM g
UNION ALL SELECT 'value', count(*) - count(value), count(value) FROM g
""")
def null_counts(spark, sf_dir):
    return clean.null_counts(_with_gaps(spark, sf_dir))


@query("drop_incomplete", f"SELECT * FROM ({_GAPS}) WHERE event_type IS NOT NULL AND value IS NOT NULL")
def drop_incomplete(spark, sf_dir):
    return clean.drop_incomplete(_with_gaps(spark, sf_dir))


@query("drop_incomplete_subset", f"SELECT * FROM ({_GAPS}) WHERE value IS NOT NULL")
def drop_incomplete_subset(spark, sf_dir):
    return clean.drop_incomplete(_with_gaps(spark, sf_dir), ["value"])


@query("availability_flag", f"""
WITH {READINGS_SQL}
SELECT reading_id, CASE WHEN v > 0 THEN 1 WHEN v IS NOT NULL THEN 0 END AS availability FROM (
  SELECT reading_id, CASE WHEN voltage < 210 THEN 0 WHEN voltage < 240 THEN voltage END AS v FROM readings)
""")
def availability_flag(spark, sf_dir):
    volts = F.col("voltage")
    rows = readings(spark, sf_dir).withColumn(
        "voltage", F.when(volts < 210, 0).when(volts < 240, volts)
    )
    return network.availability(rows).select("reading_id", "availability")


@query("excess_flag", """
SELECT event_id, CAST(CASE WHEN value > 5.0 THEN 1 ELSE 0 END AS INTEGER) AS excess_usage FROM events
""")
def excess_flag(spark, sf_dir):
    return regression.flag_excess(table(spark, sf_dir, "events"), "value").select("event_id", "excess_usage")


@query("key_filter", f"""
WITH {READINGS_SQL}
SELECT reading_id, household_id FROM parts WHERE district = 'NATION_3' AND date_part = '2024-01-15'
""")
def key_filter(spark, sf_dir):
    rows = enrich.add_time_parts(readings(spark, sf_dir))
    found = filters.by_keys(rows, district="NATION_3", date_part="2024-01-15")
    return found.select("reading_id", "household_id")


@query("day_range", f"""
WITH {READINGS_SQL}
SELECT reading_id, district, date_part FROM parts
WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-13'
""")
def day_range(spark, sf_dir):
    rows = filters.on_days(readings(spark, sf_dir), "2024-01-10", "2024-01-12")
    return enrich.add_time_parts(rows).select("reading_id", "district", "date_part")


@query("project_kind", f"""
WITH {READINGS_SQL}
SELECT household_id, device_id, reading_id, electricity_usage_kwh, voltage,
       round("current", 9) AS "current", formatted_timestamp, date_part, "hour", "minute" FROM parts
""")
def project_kind(spark, sf_dir):
    rows = enrich.enrich_household(readings(spark, sf_dir), measure_type="double")
    return enrich.project_for(rows, "household", ["reading_id"]).withColumn(
        "current", F.round("current", 9)
    )


@query("address_struct", f"""
WITH {READINGS_SQL}
SELECT reading_id, concat_ws('|', house_number, ward, district) AS address FROM readings
""")
def address_struct(spark, sf_dir):
    rows = decode.address_struct(readings(spark, sf_dir))
    parts = [f"address.{c}" for c in decode.ADDRESS]
    return rows.select("reading_id", F.concat_ws("|", *parts).alias("address"))


@query("float_usage", """
SELECT event_id, CAST(value AS FLOAT) AS electricity_usage_kwh FROM events
""")
def float_usage(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumnRenamed("value", "electricity_usage_kwh")
    return enrich.enrich_household(rows, ts="ts").select("event_id", "electricity_usage_kwh")


_ROW_JSON_FIELDS = "event_id long, user_id long, event_type string, value double"


@query("row_json_fields", "SELECT event_id, user_id, event_type, value FROM events")
def row_json_fields(spark, sf_dir):
    rows = encode.with_row_json(table(spark, sf_dir, "events"), ["event_id", "user_id", "event_type", "value"])
    return rows.select(F.from_json("json", _ROW_JSON_FIELDS).alias("d")).select("d.*")


@query("group_json_fields", """
SELECT nullif(event_type, 'view') AS event_type, event_id, user_id, value, true AS bounded FROM events
""")
def group_json_fields(spark, sf_dir):
    """Events as bounded JSON arrays per type, one of the types without a name."""
    per_array = 200
    rows = table(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    packed = encode.group_json(rows, ["event_type"], "event_id", per_array, ["event_id", "user_id", "value"])
    kind = "array<struct<event_id: bigint, user_id: bigint, value: double>>"
    # Arrays part by a hash: about the size asked for, never far beyond it.
    bounded = (F.col("rows") == F.json_array_length("json")) & (F.col("rows") < 2 * per_array)
    return packed.select("event_type", bounded.alias("bounded"), F.inline(F.from_json("json", kind)))


@query("split_by_key", f"""
WITH {READINGS_SQL}
SELECT reading_id, CASE WHEN reading_id % 10 < 7 THEN 'train' ELSE 'test' END AS part FROM readings
""")
def split_by_key(spark, sf_dir):
    rows = readings(spark, sf_dir).select("reading_id")
    train, test = features.split_by_key(rows, "reading_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
