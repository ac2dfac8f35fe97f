import datetime
import random

import pytest
from pyspark.sql import functions as F

from meterflow.operators import enrich, latest

BASE = datetime.datetime(2024, 9, 30, 22, 0)


def random_readings(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [
        (f"d{rng.randrange(4)}", BASE + datetime.timedelta(seconds=rng.randrange(4 * 3600)), i, rng.random())
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "device_id string, timestamp timestamp_ntz, rid int, kwh double")
    return enrich.add_time_parts(df), rows


def expected(rows, slot):
    best = {}
    for device, at, rid, _ in rows:
        key = (device, slot(at))
        best[key] = max(best.get(key, (at, rid)), (at, rid))
    return sorted(rid for _, rid in best.values())


SLOTS = {
    "minute": lambda t: t.replace(second=0),
    "hour": lambda t: t.replace(minute=0, second=0),
    "day": lambda t: t.date(),
}


@pytest.mark.parametrize("grain", list(SLOTS))
def test_latest_at_every_grain(spark, grain):
    df, rows = random_readings(spark)
    want = expected(rows, SLOTS[grain])
    got = latest.latest_at(df, ["device_id"], grain, tiebreak=["rid"])
    assert sorted(r.rid for r in got.collect()) == want
    rolled = latest.latest_rollup(df, ["device_id"], tiebreak=["rid"])[grain]
    assert sorted(r.rid for r in rolled.collect()) == want


def test_latest_needs_the_event_time_only(spark):
    df, rows = random_readings(spark)
    bare = df.select("device_id", "timestamp", "rid")
    got = latest.latest_at(bare, ["device_id"], "hour", tiebreak=["rid"])
    assert got.columns == bare.columns
    assert sorted(r.rid for r in got.collect()) == expected(rows, SLOTS["hour"])


def test_null_keys_and_times_are_kept(spark):
    df = spark.createDataFrame(
        [(None, BASE, 1), (None, BASE, 2), ("d", None, 3)], "device_id string, timestamp timestamp_ntz, rid int"
    )
    assert sorted(r.rid for r in latest.latest_at(df, ["device_id"], "day").collect()) == [2, 3]


def test_slots_follow_the_session_clock(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        # 18:29 and 18:31 UTC lie on two days in Kolkata.
        df = spark.createDataFrame([("d", "2024-01-01T18:29:00Z", 1), ("d", "2024-01-01T18:31:00Z", 2)],
                                   "device_id string, t string, rid int")
        df = df.select("device_id", F.to_timestamp("t").alias("timestamp"), "rid")
        assert latest.latest_at(df, ["device_id"], "day").count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_ties_on_the_same_second(spark):
    df = spark.createDataFrame(
        [("d", BASE, 1), ("d", BASE, 3), ("d", BASE, 2)], "device_id string, timestamp timestamp_ntz, rid int"
    )
    df = enrich.add_time_parts(df)
    assert latest.latest_at(df, ["device_id"], "day").first().rid == 3


def test_unknown_grain(spark):
    df, _ = random_readings(spark, 5)
    with pytest.raises(ValueError, match="grain"):
        latest.latest_at(df, ["device_id"], "week")


@pytest.mark.parametrize("n", [3, 1200])
def test_top_n_with_a_hot_group(spark, n):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), "id"
    )
    rows = latest.top_n_per_group(df, ["k"], ["id"], n).collect()
    hot = sorted((r.rank, r.id) for r in rows if r.k == "hot")
    assert hot == [(i + 1, 3999 - i) for i in range(n)]
    assert len([r for r in rows if r.k == "k0"]) == min(n, sum(1 for i in range(4000, 5000) if i % 7 == 0))


def test_top_k(spark):
    assert [r.id for r in latest.top_k(spark.range(100), ["id"], 3).collect()] == [99, 98, 97]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_one_shuffle_and_no_python(spark):
    df, _ = random_readings(spark, 50)
    text = plan(latest.latest_at(df, ["device_id"], "minute", tiebreak=["rid"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in text and "Python" not in text
