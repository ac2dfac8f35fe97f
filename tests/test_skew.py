import pytest
from pyspark.sql import functions as F

from meterflow import skew
from meterflow.operators.ordered import with_next


def skewed(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long")
    return spark.range(n).select(key.alias("k"), "id")


def test_hot_keys_finds_the_heavy_key_only(spark):
    df = skewed(spark)
    hot = skew.hot_keys(df, ["k"], min_rows=10)
    want = spark.range(7, 8).select(F.xxhash64("id").alias("h")).first().h
    assert list(hot) == [want] and hot[want] >= 2
    assert skew.hot_keys(df, ["k"]) == {}
    assert skew.hot_keys(df.limit(0), ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, how):
    left = skewed(spark).unionByName(spark.range(3).selectExpr("CAST(NULL AS BIGINT) AS k", "id"))
    right = spark.range(0, 400).selectExpr("id AS k", "id * 2 AS w")
    hot = skew.hot_keys(left, ["k"], min_rows=10)
    assert hot
    got = sorted(map(tuple, skew.skew_join(left, right, ["k"], how, hot=hot).fillna(-1).collect()))
    want = sorted(map(tuple, left.join(right, ["k"], how).fillna(-1).collect()))
    assert got == want


def test_skew_join_spreads_identical_rows(spark):
    left = spark.range(8000).selectExpr("CAST(7 AS BIGINT) AS k").repartition(8)
    hot = skew.hot_keys(left, ["k"], min_rows=10)
    tagged = skew.with_pieces(left, ["k"], hot, "n")
    tagged = tagged.withColumn("p", F.pmod(F.xxhash64("k", F.spark_partition_id()), F.col("n")))
    assert tagged.select("p").distinct().count() > 1


def test_a_small_share_is_hot_once_it_exceeds_a_partition(spark):
    """0.3 % of the rows in one key, with more partitions than it has shares."""
    key = F.when(F.col("id") < 300, 7).otherwise(1000 + F.col("id")).cast("long")
    df = spark.range(100_000).select(key.alias("k"), "id")
    assert skew.hot_keys(df, ["k"], min_rows=10) == {}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 2000)
        assert sorted(skew.hot_keys(df, ["k"], min_rows=10).values()) == [6]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_hot_keys_are_joined_not_inlined(spark):
    left = spark.range(2000).selectExpr("id % 100 AS k", "id")
    hot = {r.h: 3 for r in spark.range(100).select(F.xxhash64("id").alias("h")).collect()}
    assert len(hot) > skew._INLINE
    right = spark.range(80).selectExpr("id AS k", "id * 2 AS w")
    got = sorted(map(tuple, skew.skew_join(left, right, ["k"], "left", hot=hot).fillna(-1).collect()))
    assert got == sorted(map(tuple, left.join(right, ["k"], "left").fillna(-1).collect()))


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_null_keys_match_when_asked(spark, limit, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    left = spark.range(900).selectExpr("if(id % 3 = 0, NULL, id % 30) AS k", "id")
    right = spark.range(20).selectExpr("id AS k", "id AS w").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 99L AS w"))
    joined = skew.join_dimension(left, right, ["k"], "left", max_bytes=limit, null_safe=True)
    assert joined.columns == ["k", "id", "w"] and joined.count() == 900
    assert joined.filter("k IS NULL AND w = 99").count() == 300


def test_skew_join_refuses_mixed_key_types(spark):
    with pytest.raises(ValueError, match="join key"):
        skew.skew_join(spark.range(1), spark.range(1).selectExpr("CAST(id AS INT) AS id"), ["id"])


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_join_dimension_on_both_sides_of_the_bound(spark, limit, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    left = skewed(spark, 900)
    dim = spark.range(100).selectExpr("id AS k", "concat('n', id) AS name")
    joined = skew.join_dimension(left, dim, ["k"], "left", max_bytes=limit)
    assert joined.count() == 900
    assert joined.filter("name IS NULL").count() == left.filter("k >= 100").count()
    text = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
    assert ("__piece" in text) == (limit == 0)


def test_measured_size(spark):
    rows, size = skew.measured_size(spark.range(10))
    assert rows == 10 and 10 * 16 <= size < 10 * 128


def test_null_columns_count_with_their_slots(spark):
    wide = spark.range(1000).select("id", *[F.lit(None).cast("double").alias(f"c{i}") for i in range(20)])
    assert skew.measured_size(wide)[1] >= 1000 * 8 * 22
    texts = spark.range(10).select(F.repeat(F.lit("x"), 5000).alias("t"))
    assert skew.measured_size(texts)[1] >= 50_000


def test_nothing_is_measured_as_nothing(spark):
    assert skew.measured_size(spark.range(0)) == (0, 0)


def test_with_next_across_slices(spark):
    key = F.when(F.col("id") % 3 < 2, "hot")  # the rest has no group name
    df = spark.range(1000).select(key.alias("g"), (F.col("id") % 10).alias("v"), "id")
    rows = with_next(df, ["g"], ["v", "id"], ["v", "id"]).collect()
    assert len(rows) == 1000
    for group in ("hot", None):
        order = sorted((r.v, r.id) for r in rows if r.g == group)
        ahead = dict(zip(order, [*order[1:], (None, None)]))
        assert all((r.next_v, r.next_id) == ahead[(r.v, r.id)] for r in rows if r.g == group)
