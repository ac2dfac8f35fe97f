import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from catalog import models as catalog_models
from meterflow import skew
from meterflow.operators import classify, features, regression, stats
from meterflow.plans import consumption


@pytest.fixture(scope="module")
def line(spark):
    """y = 2 + 3a - b and a small fixed disturbance."""
    return spark.range(200).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b")
    ).withColumn("y", 2 + 3 * F.col("a") - F.col("b") + (F.col("id") % 3 - 1) * 0.1)


def test_assembled_vector(spark):
    df = spark.createDataFrame([("p", 0.25, 7, -1.5)], "id string, a double, b int, c double")
    rows = features.assemble(df, ["a", "b", "c"]).collect()
    assert list(rows[0].features) == [0.25, 7.0, -1.5]
    gap = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    assert features.assemble(gap, ["a", "b"], invalid="skip").count() == 1


def test_splits_are_whole_and_apart(line):
    train, test = features.split_random(line, (0.8, 0.2))
    assert train.count() + test.count() == 200 and train.join(test, "id").count() == 0
    train, test = features.split_by_key(line, "id")
    assert (train.count(), test.count()) == (140, 60)


def test_random_split_grows_in_pieces(spark, sf, monkeypatch):
    """Rows are stored in as many pieces as their number asks for, and both parts are drawn from those."""
    stored = []

    def watched(df):
        stored.append(durable(df))
        return stored[-1]

    durable = catalog_models.durable
    monkeypatch.setattr(catalog_models, "durable", watched)
    monkeypatch.setattr(catalog_models, "partitions_for", lambda session, rows: skew.partitions_for(session, rows, 100))
    row = catalog_models.random_split(spark, sf).first()
    assert (row.in_both, row.lost, row.share_fits) == (0, 0, True) and stored[0].count() == row.n
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert stored[0].rdd.getNumPartitions() == -(-lines // 100) > 8
    assert skew.partitions_for(spark, 0) == 8 and skew.partitions_for(spark, 10**9) == 1000


def test_linear_fit_and_metrics(spark, line):
    model = regression.fit_linear(line, ["a", "b"], "y")
    terms = {r.term: r.coefficient for r in regression.coefficients(spark, model, ["a", "b"]).collect()}
    assert terms["a"] == pytest.approx(3, abs=0.05) and terms["b"] == pytest.approx(-1, abs=0.05)
    predicted = regression.predict(line, model, ["a", "b"])
    row = regression.metrics(predicted, "y").first()
    for name in ("mse", "rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(predicted))
    left = regression.residuals(predicted, "y").agg(F.sum("residual")).first()[0]
    assert left == pytest.approx(0, abs=1e-6)


def test_metrics_of_nothing_and_of_a_constant(spark):
    empty = spark.createDataFrame([], "y double, prediction double")
    assert regression.metrics(empty, "y").first().n == 0
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, prediction double")
    row = regression.metrics(constant, "y").first()
    assert row.mse == 0.5 and row.r2 is None


def test_flag_excess(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (None,)], "prediction double")
    assert [r.excess_usage for r in regression.flag_excess(df).collect()] == [0, 1, None]


def newton_logistic(x, y, reg, steps=40):
    """The same objective minimised independently: mean log-loss and a penalty on standardised weights."""
    full = np.column_stack([np.ones(len(x)), x])
    penalty = reg * np.concatenate([[0.0], x.var(axis=0, ddof=1)])
    w = np.zeros(full.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-full @ w))
        slope = full.T @ (p - y) / len(y) + penalty * w
        bend = (full * (p * (1 - p))[:, None]).T @ full / len(y) + np.diag(penalty)
        w = w - np.linalg.solve(bend, slope)
    return w


def test_logistic_fit_with_overrides(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(80, 2)) * [1.0, 4.0]
    y = (x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=80) > 0.4).astype(float)
    rows = spark.createDataFrame([(float(b), Vectors.dense(a.tolist())) for a, b in zip(x, y)], ["label", "features"])
    model = classify.fit_logistic(
        rows, "features", params={"maxIter": 5, "regParam": 0.01},
        overrides={"maxIter": 200, "tol": 1e-12, "regParam": 0.1, "threshold": 0.55, "probabilityCol": "chance"},
    )
    w = newton_logistic(x, y, 0.1)
    want = 1 / (1 + np.exp(-(w[0] + x @ w[1:])))
    got = classify.predict_class(rows, model, "features").collect()
    assert [r.positive_probability for r in got] == pytest.approx(want.tolist(), abs=1e-5)
    assert [r.prediction for r in got] == (want > 0.55).astype(float).tolist()
    assert "chance" in got[0].asDict()
    with pytest.raises(ValueError, match="unknown parameter"):
        classify.fit_logistic(rows, "features", overrides={"speed": 1})


def test_correlations(line):
    matrix = {(r.row, r.col): r["corr"] for r in stats.corr_matrix(line, ["a", "b", "y"]).collect()}
    want = Correlation.corr(features.assemble(line, ["a", "b", "y"]), "features").head()[0].toArray()
    names = ["a", "b", "y"]
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            assert matrix[a, b] == pytest.approx(want[i][j])
    with_target = {r.feature: r["corr"] for r in stats.corr_with(line, ["a", "b"], "y").collect()}
    assert with_target["a"] == pytest.approx(matrix["a", "y"])


def test_normality(spark):
    normal = spark.range(4000).select(F.randn(seed=7).alias("x"))
    row = stats.normality(normal, "x").first()
    assert row.n == 4000 and abs(row.skewness) < 0.2 and row.p_value > 0.001
    flat = spark.range(4000).selectExpr("CAST(id AS DOUBLE) AS x")
    assert stats.normality(flat, "x").first().p_value < 1e-6


def test_consumption_plan(spark, tmp_path):
    def cell(i, j):
        return "?" if i % 11 == j else str(round(200 + (i * (j + 3)) % 13 / 7, 3))

    header = ["Date", *consumption.FEATURES, consumption.TARGET]
    lines = [";".join(header)] + [
        ";".join(["d"] + [cell(i, j) for j in range(6)]) for i in range(300)
    ]
    (tmp_path / "t.txt").write_text("\n".join(lines))
    from meterflow.sources.files import read_delimited

    table = read_delimited(spark, str(tmp_path / "t.txt"), ";")
    clean_rows = consumption.cleaned(table)
    assert 0 < clean_rows.count() < 300
    fitted = consumption.fit(table)
    assert fitted.metrics.first().n == fitted.predictions.count() == fitted.normality.first().n > 0


def test_class_probabilities_equal_the_models(spark):
    """Expressions against Spark's own transform, for two and three classes, and null features."""
    rng = np.random.default_rng(31)
    for classes in (2, 3):
        x = rng.normal(size=(120, 2))
        y = np.digitize(x[:, 0] + 0.3 * rng.normal(size=120), [-0.4, 0.5] if classes == 3 else [0.0])
        rows = spark.createDataFrame([(float(k), *map(float, r)) for k, r in zip(y, x)], "label double, a double, b double")
        model = classify.fit_logistic(rows, ["a", "b"], params={"maxIter": 50, "regParam": 0.01})
        ours = classify.predict_class(rows, model, ["a", "b"]).collect()
        theirs = model.transform(features.assemble(rows, ["a", "b"])).collect()
        for mine, other in zip(ours, theirs):
            assert mine.probability == pytest.approx(other.probability.toArray().tolist(), abs=1e-12)
            assert mine.prediction == other.prediction
    gaps = rows.selectExpr("label", "CAST(NULL AS DOUBLE) AS a", "b").limit(1)
    lone = classify.predict_class(gaps, model, ["a", "b"]).first()
    assert lone.probability is None and lone.prediction is None
