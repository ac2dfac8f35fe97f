"""Peaks, neighbours, ranks, regular series and fits per group over the readings."""

from pyspark.sql import functions as F

from meterflow.functions import normal
from meterflow.operators import load, nearest, network, regression, series, stats

from .network import BASE_SQL
from .registry import query
from .tables import READINGS_SQL, readings, table, transformers
from .usage import TIE

LASTING = "15 minutes"


@query("transformer_peak_load", f"""
WITH {BASE_SQL},
fed AS (
  SELECT coalesce(t.transformer_id, 'Unknown_Transformer') AS transformer_id, r."timestamp" AS moment,
         CAST(round(r.electricity_usage_kwh * 100) AS BIGINT) AS v
  FROM readings r LEFT JOIN transformers t ON r.district = t.district AND r.ward = t.ward),
changes AS (
  SELECT transformer_id, moment, v, 1 AS m FROM fed UNION ALL
  SELECT transformer_id, moment + INTERVAL {LASTING}, -v, -1 FROM fed),
instants AS (SELECT transformer_id, moment, sum(v) AS v, sum(m) AS m FROM changes GROUP BY ALL),
steps AS (
  SELECT transformer_id, moment, sum(v) OVER w AS load, sum(m) OVER w AS active FROM instants
  WINDOW w AS (PARTITION BY transformer_id ORDER BY moment))
SELECT transformer_id, CAST(load AS BIGINT) AS peak, moment AS peak_at, CAST(active AS BIGINT) AS active FROM steps
QUALIFY row_number() OVER (PARTITION BY transformer_id ORDER BY load DESC, moment) = 1
""")
def transformer_peak_load(spark, sf_dir):
    """The highest load that each transformer carries at once, and when."""
    fed = network.assign_transformer(readings(spark, sf_dir), transformers(spark, sf_dir))
    rows = fed.select(
        "transformer_id", F.col("timestamp").alias("start"), (F.col("timestamp") + F.expr(f"INTERVAL {LASTING}")).alias("end"),
        F.round(F.col("electricity_usage_kwh") * 100).cast("long").alias("v"),
    )
    return load.peak_load(rows, ["transformer_id"], "start", "end", "v")


_USERS_SQL = f"""
WITH {READINGS_SQL},
users AS (
  SELECT ward, household_id, CAST(sum(round(electricity_usage_kwh * 100)) AS BIGINT) AS usage FROM readings GROUP BY ward, household_id),
"""


def _users(spark, sf_dir):
    cents = F.round(F.col("electricity_usage_kwh") * 100).cast("long")
    return readings(spark, sf_dir).groupBy("ward", "household_id").agg(F.sum(cents).alias("usage"))


@query("ward_closest_users", f"""
{_USERS_SQL}
placed AS (SELECT *, row_number() OVER (PARTITION BY ward ORDER BY usage, household_id) AS at FROM users),
pairs AS (
  SELECT a.ward, a.household_id, a.usage, b.household_id AS near_household_id, b.usage AS near_usage, abs(a.usage - b.usage) AS gap,
         row_number() OVER (PARTITION BY a.ward, a.household_id ORDER BY abs(a.usage - b.usage), abs(a.at - b.at), b.at) AS place
  FROM placed a JOIN placed b ON a.ward = b.ward AND a.household_id <> b.household_id)
SELECT ward, household_id, usage, CAST(place AS INTEGER) AS place, near_household_id, near_usage, gap FROM pairs WHERE place <= 5
""")
def ward_closest_users(spark, sf_dir):
    """The five households of the ward whose total usage is closest."""
    return nearest.closest_k(_users(spark, sf_dir), ["ward"], "household_id", "usage", 5)


def _poly(coefficients, x):
    """A polynomial written out as powers."""
    top = len(coefficients) - 1
    return "(" + " + ".join(f"({c!r}) * power({x}, {top - k})" for k, c in enumerate(coefficients)) + ")"


def _cdf_sql(z):
    a = f"abs({z})"
    tail = (
        f"CASE WHEN {a} < 7.07106781186547 THEN exp(-{a} * {a} / 2) * {_poly(normal.CDF_UPPER, a)} / {_poly(normal.CDF_LOWER, a)} "
        f"ELSE exp(-{a} * {a} / 2) / ({a} + 1 / ({a} + 2 / ({a} + 3 / ({a} + 4 / ({a} + 0.65))))) / 2.506628274631 END"
    )
    return f"CASE WHEN {z} > 0 THEN 1 - ({tail}) ELSE {tail} END"


def _quantile_sql(p):
    r, d = f"(0.180625 - ({p} - 0.5) * ({p} - 0.5))", f"sqrt(-ln(least({p}, 1 - {p})))"
    return (
        f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {_poly(normal.MIDDLE[0], r)} / {_poly(normal.MIDDLE[1], r)} "
        f"ELSE sign({p} - 0.5) * CASE WHEN {d} <= 5 THEN {_poly(normal.SIDE[0], f'({d} - 1.6)')} / {_poly(normal.SIDE[1], f'({d} - 1.6)')} "
        f"ELSE {_poly(normal.TAIL[0], f'({d} - 5)')} / {_poly(normal.TAIL[1], f'({d} - 5)')} END END"
    )


def _order_sql(group, of):
    over = f"PARTITION BY {group}" if group else ""
    shown = f"{group}, " if group else ""
    return f"""
m AS (SELECT {shown}electricity_usage_kwh AS v, row_number() OVER ({over} ORDER BY electricity_usage_kwh) AS r,
             count(*) OVER ({over}) AS n, avg(electricity_usage_kwh) OVER ({over}) AS mu,
             stddev_samp(electricity_usage_kwh) OVER ({over}) AS sd FROM readings),
z AS (SELECT *, (v - mu) / sd AS s, (r - 0.375) / (n + 0.25) AS p FROM m),
f AS (SELECT *, {_cdf_sql("s")} AS below, {_quantile_sql("p")} AS q FROM z)
SELECT {shown}count(*) AS n, round(max(greatest(r / n - below, below - (r - 1) / n)), 9) AS ks,
       round(power(corr(v, q), 2), 9) AS shapiro_francia FROM f {of}"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in ("ks", "shapiro_francia")})


@query("usage_order_tests", f"WITH {READINGS_SQL}, {_order_sql('', '')}")
def usage_order_tests(spark, sf_dir):
    """Distance of all usages to a normal distribution, from their exact ranks."""
    return _rounded(stats.normality_by_order(readings(spark, sf_dir), "electricity_usage_kwh"))


@query("ward_order_tests", f"WITH {READINGS_SQL}, {_order_sql('ward', 'GROUP BY ward')}")
def ward_order_tests(spark, sf_dir):
    return _rounded(stats.normality_by_order(readings(spark, sf_dir), "electricity_usage_kwh", ["ward"]))


WARD_FIT_SQL = """
s AS (
  SELECT ward, count(*) AS n, avg(voltage) AS m1, avg("hour") AS m2, avg(electricity_usage_kwh) AS my,
         var_pop(voltage) AS v1, var_pop("hour") AS v2, covar_pop(voltage, "hour") AS c12, covar_pop(voltage, electricity_usage_kwh) AS c1y,
         covar_pop("hour", electricity_usage_kwh) AS c2y, var_pop(electricity_usage_kwh) AS vy
  FROM parts GROUP BY ward),
b AS (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM s)
SELECT ward, n, round(my - b1 * m1 - b2 * m2, 7) AS intercept, round(b1, 7) AS voltage, round(b2, 7) AS "hour",
       round((b1 * c1y + b2 * c2y) / vy, 9) AS r2 FROM b"""


def shown_fit(df):
    return df.select("ward", "n", *[F.round(c, 7).alias(c) for c in ("intercept", "voltage", "hour")], F.round("r2", 9).alias("r2"))


@query("ward_fit", f"WITH {READINGS_SQL},{WARD_FIT_SQL}")
def ward_fit(spark, sf_dir):
    """Usage from voltage and hour of day, one fit per ward."""
    rows = readings(spark, sf_dir).withColumn("hour", F.hour("timestamp"))
    return shown_fit(regression.grouped_fit(rows, ["ward"], ["voltage", "hour"], "electricity_usage_kwh"))


@query("household_trend", f"""
WITH {READINGS_SQL}
SELECT household_id, count(*) AS n, round(regr_intercept(electricity_usage_kwh, voltage), 7) AS intercept,
       round(regr_slope(electricity_usage_kwh, voltage), 7) AS slope, round(regr_r2(electricity_usage_kwh, voltage), 9) AS r2
FROM readings GROUP BY household_id HAVING count(DISTINCT voltage) > 2
""")
def household_trend(spark, sf_dir):
    fits = regression.grouped_fit(readings(spark, sf_dir), ["household_id"], ["voltage"], "electricity_usage_kwh")
    many = readings(spark, sf_dir).groupBy("household_id").agg(F.count_distinct("voltage").alias("v")).where("v > 2").select("household_id")
    return fits.join(many, "household_id").select(
        "household_id", "n", F.round("intercept", 7).alias("intercept"), F.round("voltage", 7).alias("slope"), F.round("r2", 9).alias("r2")
    )


@query("device_regular_hours", f"""
WITH {READINGS_SQL},
newest AS (
  SELECT device_id, date_trunc('hour', "timestamp") AS slot, electricity_usage_kwh AS kwh, voltage FROM readings
  QUALIFY row_number() OVER (PARTITION BY device_id, date_trunc('hour', "timestamp") ORDER BY "timestamp" DESC, reading_id DESC) = 1),
spans AS (SELECT device_id, min(slot) AS a, max(slot) AS b FROM newest GROUP BY device_id),
every AS (SELECT device_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS slot FROM spans)
SELECT e.device_id, e.slot, last_value(n.kwh IGNORE NULLS) OVER w AS electricity_usage_kwh, last_value(n.voltage IGNORE NULLS) OVER w AS voltage,
       n.device_id IS NULL AS filled
FROM every e LEFT JOIN newest n ON e.device_id = n.device_id AND e.slot = n.slot
WINDOW w AS (PARTITION BY e.device_id ORDER BY e.slot)
""")
def device_regular_hours(spark, sf_dir):
    """Hourly readings of every device, gaps filled with the last known one."""
    return series.regular(readings(spark, sf_dir), ["device_id"], "timestamp", ["electricity_usage_kwh", "voltage"], "1 hour", TIE)


def _votes_sql(layout, text):
    """Votes of the two ways to read day and month of one text column."""
    out = []
    for name, form in (("MM-dd-yyyy", "%m-%d-%Y"), ("dd-MM-yyyy", "%d-%m-%Y")):
        out.append(f"""
SELECT '{layout}' AS written, '{name}' AS layout, round((SELECT count(try_strptime(t, '{form}')) / count(*) FROM {text}), 9) AS parsed,
       coalesce((SELECT round(max(c) / sum(c), 9) FROM (
         SELECT step, count(*) AS c FROM (
           SELECT CASE WHEN day(d) = day(e) THEN concat((year(e) - year(d)) * 12 + month(e) - month(d), ' months') ELSE concat(date_diff('day', d, e), ' days') END AS step
           FROM (SELECT d, lead(d) OVER (ORDER BY d) AS e FROM (SELECT DISTINCT CAST(try_strptime(t, '{form}') AS DATE) AS d FROM {text}) WHERE d IS NOT NULL)
           WHERE e IS NOT NULL) GROUP BY step)), 0.0) AS regular""")
    return out


@query("date_layouts", f"""
WITH days AS (SELECT o_orderdate AS d FROM orders),
a AS (SELECT strftime(d, '%m-%d-%Y') AS t FROM days), b AS (SELECT strftime(d, '%d-%m-%Y') AS t FROM days),
c AS (SELECT strftime(date_trunc('month', d), '%m-%d-%Y') AS t FROM days)
{" UNION ALL ".join([*_votes_sql('american', 'a'), *_votes_sql('european', 'b'), *_votes_sql("monthly", "c")])}
""")
def date_layouts(spark, sf_dir):
    """How well each layout reads order dates that were written in either order, and monthly ones."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("d"))
    written = {"american": F.date_format("d", "MM-dd-yyyy"), "european": F.date_format("d", "dd-MM-yyyy"), "monthly": F.date_format(F.trunc("d", "month"), "MM-dd-yyyy")}
    out = None
    for name, text in written.items():
        votes = series.layout_votes(days.select(text.alias("t")), "t", ("MM-dd-yyyy", "dd-MM-yyyy"))
        one = votes.select(F.lit(name).alias("written"), "layout", F.round("parsed", 9).alias("parsed"), F.round("regular", 9).alias("regular"))
        out = one if out is None else out.unionByName(one)
    return out
