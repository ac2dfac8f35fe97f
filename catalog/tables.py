"""Meter readings seen through the star-schema tables.

Events are readings, their users households, the users' market segment, nation
and region the ward, district and city. The SQL strings build the same views.
"""

from pyspark.sql import functions as F

from meterflow.skew import join_dimension

CUSTOMER_PLACE_SQL = """
place AS (
  SELECT c.c_custkey, CAST(c.c_custkey AS VARCHAR) AS house_number,
         c.c_mktsegment AS ward, n.n_name AS district, r.r_name AS city
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

READINGS_SQL = f"""{CUSTOMER_PLACE_SQL},
readings AS (
  SELECT e.event_id AS reading_id, 'household' AS "type",
         concat('H', e.user_id) AS household_id,
         concat('household-', p.city, '-', p.district, '-', p.house_number) AS device_id,
         e.ts AS "timestamp", e.value AS electricity_usage_kwh,
         CAST(200 + e.event_id % 51 AS INTEGER) AS voltage,
         e.value / (200 + e.event_id % 51) AS "current",
         p.house_number, p.ward, p.district, p.city,
         CAST(1800 AS INTEGER) AS price_per_kwh,
         CAST(floor(e.value * 1800) AS INTEGER) AS total_cost
  FROM events e JOIN place p ON e.user_id = p.c_custkey
),
parts AS (
  SELECT *, CAST(year("timestamp") AS INTEGER) AS "year",
         CAST(month("timestamp") AS INTEGER) AS "month",
         CAST(hour("timestamp") AS INTEGER) AS "hour",
         CAST(minute("timestamp") AS INTEGER) AS "minute",
         strftime("timestamp", '%Y-%m-%d') AS date_part,
         strftime("timestamp", '%Y-%m-%d %H-%M-%S') AS formatted_timestamp
  FROM readings
)"""

AREA_SQL = f"""{READINGS_SQL},
area AS (
  SELECT 'area' AS "type", concat('area-', city, '-', district) AS device_id,
         ward, district, city, date_trunc('minute', "timestamp") AS "timestamp",
         sum(electricity_usage_kwh) AS total_electricity_usage_kwh
  FROM readings GROUP BY ward, district, city, date_trunc('minute', "timestamp")
)"""

# Transformers feed one ward of one district each; one segment has none.
TRANSFORMERS_SQL = """
transformers AS (
  SELECT DISTINCT concat('T', n.n_nationkey, '-', c.c_mktsegment) AS transformer_id,
         n.n_name AS district, c.c_mktsegment AS ward
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_mktsegment <> 'MACHINERY'
)"""

BATCH_LOG_SQL = """
batch_log AS (
  SELECT event_type AS "type", strftime(ts, '%Y-%m-%d %H') AS batch_id,
         max(ts) AS ts, count(*) AS records,
         CAST(sum(floor(value)) AS BIGINT) AS duration_ms,
         count(CASE WHEN value > 400 THEN 1 END) AS errors
  FROM events GROUP BY 1, 2
)"""


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_place(facts, spark, sf_dir):
    """Facts of customers (``c_custkey``) with house number, ward, district, city.

    Nations and regions join after the customers, so that each side's size is
    known from its own files.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = join_dimension(facts, customer, ["c_custkey"])
    joined = joined.join(nation, joined.c_nationkey == nation.n_nationkey)
    joined = joined.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(
        *facts.columns,
        F.col("c_custkey").cast("string").alias("house_number"),
        F.col("c_mktsegment").alias("ward"),
        F.col("n_name").alias("district"),
        F.col("r_name").alias("city"),
    )


def as_readings(events, spark, sf_dir, keep=()):
    """Events as household readings; works on batch and streaming events."""
    joined = with_place(events.withColumnRenamed("user_id", "c_custkey"), spark, sf_dir)
    voltage = 200 + F.col("event_id") % 51
    device = F.concat_ws("-", F.lit("household"), "city", "district", "house_number")
    return joined.select(
        F.col("event_id").alias("reading_id"),
        F.lit("household").alias("type"),
        F.concat(F.lit("H"), F.col("c_custkey")).alias("household_id"),
        device.alias("device_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("electricity_usage_kwh"),
        voltage.cast("int").alias("voltage"),
        (F.col("value") / voltage).alias("current"),
        "house_number", "ward", "district", "city",
        F.lit(1800).alias("price_per_kwh"),
        F.floor(F.col("value") * 1800).cast("int").alias("total_cost"),
        *keep,
    )


def readings(spark, sf_dir):
    return as_readings(table(spark, sf_dir, "events"), spark, sf_dir)


def area_totals(spark, sf_dir):
    """Kilowatt hours per ward and minute."""
    rows = readings(spark, sf_dir)
    minute = F.date_trunc("minute", "timestamp").cast("timestamp_ntz").alias("timestamp")
    sums = rows.groupBy("ward", "district", "city", minute).agg(
        F.sum("electricity_usage_kwh").alias("total_electricity_usage_kwh")
    )
    return sums.select(
        F.lit("area").alias("type"),
        F.concat_ws("-", F.lit("area"), "city", "district").alias("device_id"),
        "ward", "district", "city", "timestamp", "total_electricity_usage_kwh",
    )


def transformers(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    nation = table(spark, sf_dir, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.select(
        F.concat(F.lit("T"), "n_nationkey", F.lit("-"), "c_mktsegment").alias("transformer_id"),
        F.col("n_name").alias("district"),
        F.col("c_mktsegment").alias("ward"),
    ).distinct()


def order_readings(spark, sf_dir):
    """Orders as readings of their customers, spanning several years."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("H"), F.col("o_custkey")).alias("household_id"),
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("electricity_usage_kwh"),
    )


def batch_log(spark, sf_dir):
    """A per-batch progress log: one batch per event type and hour."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.col("event_type").alias("type"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("batch_id"),
    ).agg(
        F.max("ts").alias("ts"),
        F.count("*").alias("records"),
        F.sum(F.floor("value")).alias("duration_ms"),
        F.count(F.when(F.col("value") > 400, 1)).alias("errors"),
    )
