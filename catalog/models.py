"""Statistics, features and models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from meterflow.durable import durable, work_dir
from meterflow.operators import classify, features, regression, series, stats
from meterflow.plans import consumption
from meterflow.skew import partitions_for
from meterflow.sources.files import read_delimited

from .registry import query
from .tables import table

COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
TARGET = "l_extendedprice"
INPUTS = ["l_quantity", "l_discount"]

# Least squares of the price on quantity and discount, from covariances.
FIT_SQL = """
s AS (
  SELECT avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
         var_pop(l_quantity) AS v1, var_pop(l_discount) AS v2,
         covar_pop(l_quantity, l_discount) AS c12,
         covar_pop(l_quantity, l_extendedprice) AS c1y, covar_pop(l_discount, l_extendedprice) AS c2y
  FROM lineitem),
b AS (
  SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1,
         (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM s),
fit AS (SELECT my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM b)"""


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _fit(spark, sf_dir):
    return regression.fit_linear(_lines(spark, sf_dir), INPUTS, TARGET)


@query("corr_with_target", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, {TARGET}), 9) AS corr FROM lineitem" for c in COLUMNS[:3]
))
def corr_with_target(spark, sf_dir):
    return stats.corr_with(_lines(spark, sf_dir), COLUMNS[:3], TARGET).withColumn("corr", F.round("corr", 9))


@query("corr_matrix", "\nUNION ALL ".join(
    f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr({a}, {b}), 9) AS corr FROM lineitem"
    for a in COLUMNS for b in COLUMNS
))
def corr_matrix(spark, sf_dir):
    return stats.corr_matrix(_lines(spark, sf_dir), COLUMNS).withColumn("corr", F.round("corr", 9))


@query("date_series", """
SELECT CAST(o_orderdate AS DATE) AS "Date", o_totalprice FROM orders
""")
def date_series(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("t", F.date_format("o_orderdate", "MM-dd-yyyy"))
    return series.date_indexed(rows, "t", "o_totalprice")


@query("assembled_features", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem
""")
def assembled_features(spark, sf_dir):
    rows = features.assemble(_lines(spark, sf_dir), COLUMNS[:3])
    values = vector_to_array("features")
    return rows.select("l_orderkey", "l_linenumber", *[values[i].alias(f"f{i}") for i in range(3)])


@query("random_split", """
SELECT count(*) AS n, 0 AS in_both, 0 AS lost, true AS share_fits
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)
""")
def random_split(spark, sf_dir):
    """Which row falls where is up to chance; that the parts are whole, apart and of their size is not.

    The rows are stored once, so that both parts are drawn from the same ones, in as many pieces as keep
    a task's sort small; rows and parts then meet in one grouping of as many pieces.
    """
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = _lines(spark, sf_dir).select(*keys)
    pieces = partitions_for(spark, lines.count())
    rows = durable(lines.repartition(pieces, *keys).distinct())
    train, test = features.split_random(rows)
    tagged = rows.withColumn("of", F.lit(1))
    for part, name in ((train, "a"), (test, "b")):
        tagged = tagged.unionByName(part.withColumn(name, F.lit(1)), allowMissingColumns=True)
    parts = tagged.repartition(pieces, *keys).groupBy(*keys).agg(*[F.count(c).alias(c) for c in ("of", "a", "b")])
    return parts.agg(
        F.count_if(F.col("of") > 0).alias("n"), F.count_if(F.col("a") + F.col("b") > 1).cast("int").alias("in_both"),
        F.count_if((F.col("of") > 0) & (F.col("a") + F.col("b") == 0)).cast("int").alias("lost"),
        (F.abs(F.avg("a") - 0.7) < 0.03).alias("share_fits"),
    )


@query("linear_fit", f"""
WITH {FIT_SQL}
SELECT 'intercept' AS term, round(b0, 5) AS coefficient FROM fit
UNION ALL SELECT 'l_quantity', round(b1, 5) FROM fit
UNION ALL SELECT 'l_discount', round(b2, 5) FROM fit
""")
def linear_fit(spark, sf_dir):
    rows = regression.coefficients(spark, _fit(spark, sf_dir), INPUTS)
    return rows.withColumn("coefficient", F.round("coefficient", 5))


def _predictions(spark, sf_dir):
    rows = regression.predict(_lines(spark, sf_dir), _fit(spark, sf_dir), INPUTS)
    return regression.residuals(rows, TARGET)


@query("linear_predict", f"""
WITH {FIT_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, round(b0 + b1 * l_quantity + b2 * l_discount, 4) AS prediction,
       round(l_extendedprice - (b0 + b1 * l_quantity + b2 * l_discount), 4) AS residual
FROM lineitem CROSS JOIN fit
""")
def linear_predict(spark, sf_dir):
    return _predictions(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("prediction", 4).alias("prediction"),
        F.round("residual", 4).alias("residual"),
    )


@query("regression_metrics", f"""
WITH {FIT_SQL},
p AS (SELECT l_extendedprice AS y, b0 + b1 * l_quantity + b2 * l_discount AS f FROM lineitem CROSS JOIN fit)
SELECT count(*) AS n, round(avg((y - f) * (y - f)), 2) AS mse, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse,
       round(1 - avg((y - f) * (y - f)) / var_pop(y), 9) AS r2 FROM p
""")
def regression_metrics(spark, sf_dir):
    row = regression.metrics(_predictions(spark, sf_dir), TARGET)
    return row.select("n", F.round("mse", 2).alias("mse"), F.round("rmse", 6).alias("rmse"), F.round("r2", 9).alias("r2"))


_MOMENTS_SQL = """
m AS (SELECT avg({x}) AS mean FROM {rows}),
c AS (
  SELECT count(*) AS n, avg(pow({x} - mean, 2)) AS m2, avg(pow({x} - mean, 3)) AS m3,
         avg(pow({x} - mean, 4)) AS m4 FROM {rows} CROSS JOIN m),
k AS (SELECT n, m3 / pow(m2, 1.5) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis FROM c),
j AS (SELECT *, n / 6.0 * (pow(skewness, 2) + pow(kurtosis, 2) / 4) AS jb FROM k)
SELECT n, round(skewness, 8) AS skewness, round(kurtosis, 8) AS kurtosis, round(jb, 4) AS jarque_bera,
       round(exp(-jb / 2), 9) AS p_value FROM j"""


def _shown(row):
    digits = {"skewness": 8, "kurtosis": 8, "jarque_bera": 4, "p_value": 9}
    return row.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("normality", "WITH " + _MOMENTS_SQL.format(x="value", rows="events"))
def normality(spark, sf_dir):
    return _shown(stats.normality(table(spark, sf_dir, "events"), "value"))


@query("residual_normality", f"WITH {FIT_SQL}, p AS (SELECT l_extendedprice - (b0 + b1 * l_quantity + "
       "b2 * l_discount) AS res FROM lineitem CROSS JOIN fit)," + _MOMENTS_SQL.format(x="res", rows="p"))
def residual_normality(spark, sf_dir):
    return _shown(stats.normality(_predictions(spark, sf_dir), "residual"))


@query("excess_predictions", f"""
WITH {FIT_SQL}
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CASE WHEN b0 + b1 * l_quantity + b2 * l_discount > 40000 THEN 1 ELSE 0 END AS INTEGER) AS excess_usage
FROM lineitem CROSS JOIN fit
""")
def excess_predictions(spark, sf_dir):
    rows = regression.flag_excess(_predictions(spark, sf_dir), threshold=40000.0)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "excess_usage")


def _logistic_sql(reg=0.1, steps=12):
    """Newton's steps for the regularised logistic fit, a chain of sums and 3 x 3 solutions."""
    parts = [f"""
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS x1, l_discount AS x2,
                  CASE WHEN l_extendedprice > 50000 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM lineitem),
s AS (SELECT {reg} * var_samp(x1) AS r1, {reg} * var_samp(x2) AS r2 FROM d),
b0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c)"""]
    for k in range(steps):
        parts.append(f"""
p{k} AS (SELECT x1, x2, y, 1 / (1 + exp(-(a + b * x1 + c * x2))) AS p FROM d CROSS JOIN b{k}),
m{k} AS (
  SELECT a, b, c, g0, g1 + r1 * b AS g1, g2 + r2 * c AS g2, h00, h01, h02, h11 + r1 AS h11, h12, h22 + r2 AS h22
  FROM (SELECT avg(p - y) AS g0, avg((p - y) * x1) AS g1, avg((p - y) * x2) AS g2, avg(p * (1 - p)) AS h00,
               avg(p * (1 - p) * x1) AS h01, avg(p * (1 - p) * x2) AS h02, avg(p * (1 - p) * x1 * x1) AS h11,
               avg(p * (1 - p) * x1 * x2) AS h12, avg(p * (1 - p) * x2 * x2) AS h22 FROM p{k})
  CROSS JOIN b{k} CROSS JOIN s),
b{k + 1} AS (
  SELECT a - ((h11 * h22 - h12 * h12) * g0 + (h02 * h12 - h01 * h22) * g1 + (h01 * h12 - h02 * h11) * g2) / det AS a,
         b - ((h02 * h12 - h01 * h22) * g0 + (h00 * h22 - h02 * h02) * g1 + (h01 * h02 - h00 * h12) * g2) / det AS b,
         c - ((h01 * h12 - h02 * h11) * g0 + (h01 * h02 - h00 * h12) * g1 + (h00 * h11 - h01 * h01) * g2) / det AS c
  FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h02 * h12) + h02 * (h01 * h12 - h02 * h11) AS det FROM m{k}))""")
    return ",".join(parts) + f"""
SELECT l_orderkey, l_linenumber, l_partkey, y AS label, round(p, 4) AS probability,
       CASE WHEN p > 0.55 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM (SELECT *, 1 / (1 + exp(-(a + b * x1 + c * x2))) AS p FROM d CROSS JOIN b{steps})"""


@query("logistic_predict", _logistic_sql())
def logistic_predict(spark, sf_dir):
    """Dear lines from their quantity and discount, with overridden parameters."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
        (F.col("l_extendedprice") > 50000).cast("double").alias("label"),
    )
    inputs = ["l_quantity", "l_discount"]
    model = classify.fit_logistic(
        rows, inputs, params={"maxIter": 10, "regParam": 0.01},
        overrides={"maxIter": 200, "tol": 1e-13, "regParam": 0.1, "threshold": 0.55, "probabilityCol": "positive"},
    )
    scored = classify.predict_class(rows, model, inputs)
    return scored.select(
        "l_orderkey", "l_linenumber", "l_partkey", "label", F.round("positive_probability", 4).alias("probability"),
        "prediction",
    )


_METERED = ["Date", "Voltage", "Global_intensity", "Global_active_power"]
_METERED_SQL = """
rows AS (
  SELECT l_orderkey AS k, l_quantity AS x1, l_discount AS x2, l_extendedprice AS y FROM lineitem WHERE l_linenumber <> 6),
train AS (SELECT * FROM rows WHERE k % 10 < 7), test AS (SELECT * FROM rows WHERE k % 10 >= 7),
s AS (
  SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12,
         covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y FROM train),
b AS (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM s),
p AS (SELECT y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS f FROM test CROSS JOIN b)"""


def _metered(spark, sf_dir):
    """Lines as a consumption table in a ``;`` file, with gaps written as a question mark."""
    path = work_dir(spark, "metered")
    gap = F.col("l_linenumber") == 6
    rows = _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("Date"), F.when(gap, "?").otherwise(F.col("l_quantity").cast("string")).alias("Voltage"),
        F.col("l_discount").alias("Global_intensity"), F.col("l_extendedprice").alias("Global_active_power"),
    )
    rows.write.option("header", True).option("sep", ";").csv(path)
    schema = "Date long, Voltage string, Global_intensity string, Global_active_power string"
    return read_delimited(spark, path, ";", schema)


@query("consumption_table", f"WITH {_METERED_SQL} SELECT x1 AS voltage, round(x2, 2) AS intensity, round(y, 2) AS power FROM rows")
def consumption_table(spark, sf_dir):
    rows = consumption.cleaned(_metered(spark, sf_dir), _METERED[1:])
    rows = rows.toDF("voltage", "intensity", "power").select(*[F.col(c).cast("double").alias(c) for c in ("voltage", "intensity", "power")])
    return rows.withColumns({c: F.round(c, 2) for c in ("intensity", "power")})


@query("consumption_fit", f"""
WITH {_METERED_SQL}
SELECT count(*) AS n, round(avg((y - f) * (y - f)) / 10000) AS mse, round(1 - avg((y - f) * (y - f)) / var_pop(y), 6) AS r2 FROM p
""")
def consumption_fit(spark, sf_dir):
    """The consumption job end to end: scan, clean, split, fit, judge."""
    fitted = consumption.fit(_metered(spark, sf_dir), _METERED[1:3], _METERED[3], key="Date")
    return fitted.metrics.select("n", F.round(F.col("mse") / 10000).alias("mse"), F.round("r2", 6).alias("r2"))
