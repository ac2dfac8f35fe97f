"""Latest rows, history, profiles and totals."""

from pyspark.sql import functions as F

from meterflow.functions import keys
from meterflow.functions.timeparts import stamp
from meterflow.operators import enrich, filters, latest, progress, usage
from meterflow.plans import monthly

from .registry import query
from .tables import (
    AREA_SQL, BATCH_LOG_SQL, CUSTOMER_PLACE_SQL, READINGS_SQL, area_totals, batch_log, order_readings,
    readings, table, with_place,
)

TIE = ["reading_id"]
SLOTS = {"minute": ["date_part", "hour", "minute"], "hour": ["date_part", "hour"], "day": ["date_part"]}


def _latest_sql(grain, group="device_id", path="device_id"):
    slot = ", ".join(f'"{c}"' for c in SLOTS[grain])
    steps = ", '/', ".join(f'"{c}"' for c in SLOTS[grain])
    return f"""
WITH {READINGS_SQL}
SELECT device_id, reading_id, formatted_timestamp, electricity_usage_kwh, voltage,
       concat({path}, '/', {steps}, '.json') AS object_key
FROM parts QUALIFY row_number() OVER (
  PARTITION BY {group}, {slot} ORDER BY "timestamp" DESC, reading_id DESC) = 1
"""


def _shown(rows, grain, path=("device_id",)):
    return enrich.add_time_parts(rows).select(
        "device_id", "reading_id", "formatted_timestamp", "electricity_usage_kwh", "voltage",
        keys.object_key(*path, *SLOTS[grain]).alias("object_key"),
    )


def enriched(spark, sf_dir):
    return enrich.enrich_household(readings(spark, sf_dir), measure_type="double")


@query("latest_minute", _latest_sql("minute"))
def latest_minute(spark, sf_dir):
    return _shown(latest.latest_at(readings(spark, sf_dir), ["device_id"], "minute", tiebreak=TIE), "minute")


@query("latest_hour", _latest_sql("hour"))
def latest_hour(spark, sf_dir):
    return _shown(latest.latest_at(readings(spark, sf_dir), ["device_id"], "hour", tiebreak=TIE), "hour")


@query("latest_day", _latest_sql("day"))
def latest_day(spark, sf_dir):
    return _shown(latest.latest_at(readings(spark, sf_dir), ["device_id"], "day", tiebreak=TIE), "day")


@query("latest_hour_of_minutes", _latest_sql("hour"))
def latest_hour_of_minutes(spark, sf_dir):
    return _shown(latest.latest_rollup(readings(spark, sf_dir), ["device_id"], tiebreak=TIE)["hour"], "hour")


@query("latest_day_of_hours", _latest_sql("day"))
def latest_day_of_hours(spark, sf_dir):
    return _shown(latest.latest_rollup(readings(spark, sf_dir), ["device_id"], tiebreak=TIE)["day"], "day")


_DEEP = ["type", "device_id", "city", "district"]


@query("latest_by_location", _latest_sql(
    "hour", '"type", device_id, city, district', "\"type\", '/', device_id, '/', city, '/', district"
))
def latest_by_location(spark, sf_dir):
    rows = latest.latest_at(readings(spark, sf_dir), _DEEP, "hour", tiebreak=TIE)
    return _shown(rows, "hour", _DEEP)


@query("latest_area_hour", f"""
WITH {AREA_SQL}
SELECT device_id, ward, strftime("timestamp", '%Y-%m-%d %H-%M-%S') AS formatted_timestamp,
       round(total_electricity_usage_kwh, 6) AS total_kwh
FROM area QUALIFY row_number() OVER (
  PARTITION BY device_id, date_trunc('hour', "timestamp") ORDER BY "timestamp" DESC, ward DESC) = 1
""")
def latest_area_hour(spark, sf_dir):
    newest = latest.latest_at(area_totals(spark, sf_dir), ["device_id"], "hour", tiebreak=["ward"])
    return enrich.enrich_area(newest, measure_type="double").select(
        "device_id", "ward", "formatted_timestamp", F.round("total_electricity_usage_kwh", 6).alias("total_kwh")
    )


@query("top_n_batches", f"""
WITH {BATCH_LOG_SQL}
SELECT "type", batch_id, records, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "type" ORDER BY batch_id DESC) AS rank FROM batch_log)
WHERE rank <= 10
""")
def top_n_batches(spark, sf_dir):
    newest = latest.top_n_per_group(batch_log(spark, sf_dir), ["type"], ["batch_id"], 10)
    return newest.select("type", "batch_id", "records", "rank")


@query("top_n_long_history", """
SELECT event_type, event_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rank FROM events)
WHERE rank <= 1500
""")
def top_n_long_history(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    newest = latest.top_n_per_group(rows, ["event_type"], ["ts", "event_id"], 1500)
    return newest.select("event_type", "event_id", "rank")


@query("top_k", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H-%M-%S') AS stamp, value
FROM events ORDER BY ts DESC, event_id DESC LIMIT 50
""")
def top_k(spark, sf_dir):
    newest = latest.top_k(table(spark, sf_dir, "events"), ["ts", "event_id"], 50)
    return newest.select("event_id", stamp("ts").alias("stamp"), "value")


_ORDER_SQL = f"""
{CUSTOMER_PLACE_SQL},
parts AS (
  SELECT concat('H', o.o_custkey) AS household_id, o.o_totalprice AS electricity_usage_kwh,
         CAST(year(o.o_orderdate) AS INTEGER) AS "year", CAST(month(o.o_orderdate) AS INTEGER) AS "month",
         p.ward, p.district
  FROM orders o JOIN place p ON o.o_custkey = p.c_custkey
)"""


def _order_parts(spark, sf_dir):
    rows = with_place(order_readings(spark, sf_dir), spark, sf_dir)
    return enrich.add_time_parts(rows)


@query("household_month_profile", f"""
WITH {READINGS_SQL}
SELECT household_id, "year", "month",
       min(electricity_usage_kwh) AS min_electricity_usage_kwh,
       max(electricity_usage_kwh) AS max_electricity_usage_kwh,
       round(avg(electricity_usage_kwh), 9) AS avg_electricity_usage_kwh,
       min(voltage) AS min_voltage, max(voltage) AS max_voltage, round(avg(voltage), 9) AS avg_voltage
FROM parts GROUP BY household_id, "year", "month"
""")
def household_month_profile(spark, sf_dir):
    return monthly.household_month(enriched(spark, sf_dir)).withColumns({
        c: F.round(c, 9) for c in ("avg_electricity_usage_kwh", "avg_voltage")
    })


@query("household_month_profile_orders", f"""
WITH {_ORDER_SQL}
SELECT household_id, "year", "month",
       min(electricity_usage_kwh) AS min_electricity_usage_kwh,
       max(electricity_usage_kwh) AS max_electricity_usage_kwh,
       round(avg(electricity_usage_kwh), 4) AS avg_electricity_usage_kwh
FROM parts GROUP BY household_id, "year", "month"
""")
def household_month_profile_orders(spark, sf_dir):
    rows = monthly.household_month(_order_parts(spark, sf_dir), ["electricity_usage_kwh"])
    return rows.withColumn("avg_electricity_usage_kwh", F.round("avg_electricity_usage_kwh", 4))


@query("district_month_total", f"""
WITH {_ORDER_SQL}
SELECT district, "year", "month", round(sum(electricity_usage_kwh), 2) AS total_electricity_usage
FROM parts GROUP BY district, "year", "month"
""")
def district_month_total(spark, sf_dir):
    rows = monthly.district_month(_order_parts(spark, sf_dir))
    return rows.withColumn("total_electricity_usage", F.round("total_electricity_usage", 2))


@query("household_ward_month_profile", f"""
WITH {READINGS_SQL}
SELECT household_id, "year", "month", district, ward,
       min(electricity_usage_kwh) AS min_electricity_usage_kwh,
       max(electricity_usage_kwh) AS max_electricity_usage_kwh,
       round(avg(electricity_usage_kwh), 9) AS avg_electricity_usage_kwh,
       min(voltage) AS min_voltage, max(voltage) AS max_voltage, round(avg(voltage), 9) AS avg_voltage,
       lower(concat(replace(district, ' ', '-'), '-', replace(ward, ' ', '-'), '-', "year", '-', "month"))
         AS bucket_name
FROM parts GROUP BY household_id, "year", "month", district, ward
""")
def household_ward_month_profile(spark, sf_dir):
    return monthly.household_ward_month(enriched(spark, sf_dir)).withColumns({
        c: F.round(c, 9) for c in ("avg_electricity_usage_kwh", "avg_voltage")
    })


@query("distinct_keys", f"""
WITH {READINGS_SQL} SELECT DISTINCT device_id, date_part, "hour" FROM parts
""")
def distinct_keys(spark, sf_dir):
    rows = enrich.add_time_parts(readings(spark, sf_dir))
    return filters.distinct_keys(rows, "device_id", "date_part", "hour")


@query("group_counts", "SELECT event_type, user_id, count(*) AS rows FROM events GROUP BY event_type, user_id")
def group_counts(spark, sf_dir):
    return usage.group_counts(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query("row_counts", """
SELECT count(*) AS records, count(CASE WHEN event_type <> 'view' THEN 1 END) AS valid,
       count(CASE WHEN event_type = 'view' THEN 1 END) AS refused FROM events
""")
def row_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("view")).alias("event_type")
    )
    seen, counts = progress.observe_counts(events, ["event_type"])
    seen.write.format("noop").mode("overwrite").save()
    names = ["records", "valid", "refused"]
    return spark.createDataFrame([tuple(counts.get[n] for n in names)], "records long, valid long, refused long")
