import pytest

from meterflow.operators import progress


@pytest.fixture(scope="module")
def log(spark):
    rows = [("household", 0, 100, 2000, "2024-01-01 00:00:00"), ("household", 1, 50, 0, "2024-01-01 00:00:10"),
            ("area", 0, 10, 500, "2024-01-01 00:00:40")]
    df = spark.createDataFrame(rows, "type string, batch_id long, records long, duration_ms long, at string")
    return df.selectExpr("type", "batch_id", "records", "duration_ms", "CAST(at AS TIMESTAMP) AS ts")


def test_rates(log):
    rows = {(r.type, r.batch_id): r.processing_rate for r in progress.with_rates(log).collect()}
    assert rows == {("household", 0): 50.0, ("household", 1): 0.0, ("area", 0): 20.0}


def test_summary(log):
    rows = {r.type: tuple(r)[1:] for r in progress.summary(log).collect()}
    assert rows == {"household": (2, 150, 2000, 75.0), "area": (1, 10, 500, 20.0), "total": (3, 160, 2500, 64.0)}


def test_runtime(log):
    assert tuple(progress.runtime_throughput(log).first()) == (160, 40.0, 4.0)
    assert progress.runtime_throughput(log.limit(1)).first().records_per_second == 100.0


def test_errors(spark):
    df = spark.createDataFrame([("put",), ("put",), ("fetch",), (None,)], "error_type string")
    rows = {r.error_type: r.errors for r in progress.error_counts(df).collect()}
    assert rows == {"put": 2, "fetch": 1, "total": 3}
    assert [tuple(r) for r in progress.error_counts(df.limit(0)).collect()] == [("total", 0)]


def test_status(spark):
    jobs = spark.createDataFrame([("RUNNING",), ("SUCCEEDED",), ("SUCCEEDED",), ("FAILED",), (None,)], "status string")
    assert tuple(progress.status_summary(jobs).first()) == (1, 2, 1)


def test_executors(spark):
    df = spark.createDataFrame([(4, 10, 100), (None, None, 100)], "totalCores int, memoryUsed long, maxMemory long")
    assert tuple(progress.executor_summary(df).first()) == (2, 4, 10, 200, 5.0)
    assert tuple(progress.executor_summary(df.limit(0)).first()) == (0, 0, 0, 0, 0.0)


def test_completed(log):
    row = progress.completed_batches(log).first()
    assert row.completed_batches == 3 and row.avg_processing_ms == pytest.approx(833.3333, abs=1e-3)


def test_prefixes(spark):
    df = spark.createDataFrame([("hcmc-q1/a",), ("hcmc-q2/b",), ("hanoi-x/c",)], "object_key string")
    assert {r.prefix: r.objects for r in progress.prefix_counts(df).collect()} == {"hcmc": 2, "hanoi": 1}


def test_observed_counts(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    seen, counts = progress.observe_counts(df, ["k"])
    seen.write.parquet(str(tmp_path / "t"))
    assert counts.get == {"records": 3, "valid": 2, "refused": 1}
