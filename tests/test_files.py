"""Sources and sinks, by writing and reading back."""

import json

import pytest
from pyspark.sql import functions as F

from meterflow.operators import enrich, latest
from meterflow.sinks import files as sinks
from meterflow.sources import files, kafka

ROWS = [("east", 4), ("north", 9), ("west", 16)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "name string, value int")


@pytest.mark.parametrize("sep", [",", ";"])
def test_delimited_round_trip(spark, rows, tmp_path, sep):
    rows.write.option("header", True).option("sep", sep).csv(str(tmp_path / "t"))
    back = files.read_delimited(spark, str(tmp_path / "t"), sep)
    assert back.schema["value"].dataType.simpleString() == "int"
    assert sorted(map(tuple, back.collect())) == ROWS
    fixed = files.read_delimited(spark, str(tmp_path / "t"), sep, "name string, value long")
    assert sorted(map(tuple, fixed.collect())) == ROWS


def test_text_round_trip_flattens_structs(spark, tmp_path):
    df = spark.createDataFrame([("a", ("w", None), 1.5)],
                               "id string, location struct<ward: string, city: string>, kwh double")
    path = sinks.write_text_lines(df, str(tmp_path / "t"))
    assert [r.value for r in files.read_text(spark, path).collect()] == ["a,w,1.5"]
    sinks.write_text_lines(df, path, ["id", "kwh"], mode="append")
    assert files.read_text(spark, path).count() == 2


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_append_by_key(spark, rows, tmp_path, fmt):
    path = str(tmp_path / fmt)
    for _ in range(2):
        sinks.write_partitioned(rows, path, ["name"], fmt)
    assert (tmp_path / fmt / "name=east").is_dir()
    back = spark.read.schema("value int, name string").option("header", True).format(fmt).load(path)
    assert back.count() == 6


def test_overwriting_one_folder_leaves_the_others(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(rows, path, ["name"], mode="overwrite_partitions")
    new = spark.createDataFrame([("north", 90)], "name string, value int")
    for _ in range(2):
        sinks.write_partitioned(new, path, ["name"], mode="overwrite_partitions")
    assert sorted(map(tuple, spark.read.parquet(path).select("name", "value").collect())) == [
        ("east", 4), ("north", 90), ("west", 16)
    ]


def test_repeated_batch_replaces_itself(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 1, 1):
        sinks.write_batch(rows, batch, path)
    assert spark.read.parquet(path).count() == 6


def test_bad_arguments(spark, rows, tmp_path):
    with pytest.raises(ValueError, match="format"):
        sinks.write_partitioned(rows, str(tmp_path), fmt="xml")
    with pytest.raises(ValueError, match="partition keys"):
        sinks.write_partitioned(rows, str(tmp_path), mode="overwrite_partitions")
    with pytest.raises(ValueError, match="missing"):
        sinks.write_partitioned(rows, str(tmp_path), ["nothing"])


def test_hot_folder_is_split_and_small_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "t")
    key = F.when(F.col("id") < 90_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3))
    rows = spark.range(0, 100_000, 1, 8).select(key.alias("k"), "id", F.xxhash64("id").alias("v"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "100k")
        sinks.write_partitioned(rows, path, ["k"])
    finally:
        spark.conf.set(size, before)
    counts = files.list_objects(spark, path, "*.parquet").select(
        F.regexp_extract("path", "k=([^/]+)/", 1).alias("k")
    ).groupBy("k").count().collect()
    assert all(r["count"] <= 2 for r in counts if r.k != "hot")
    assert all(r["count"] >= 4 for r in counts if r.k == "hot")
    assert spark.read.parquet(path).count() == 100_000


def readings(spark, *rows):
    df = spark.createDataFrame(list(rows), "device_id string, at string, kwh double")
    df = df.select("device_id", F.col("at").cast("timestamp_ntz").alias("timestamp"), "kwh")
    return enrich.add_time_parts(df)


def test_latest_layout(spark, tmp_path):
    first = readings(spark, ("d1", "2024-09-29 10:05:01", 1.0), ("d2", "2024-09-29 10:05:01", 2.0))
    second = readings(spark, ("d1", "2024-09-29 10:05:30", 3.0))
    path = str(tmp_path / "t")
    for batch in (first, second):
        sinks.write_latest(latest.latest_at(batch, ["device_id"], "minute"), path, "minute")
    folder = tmp_path / "t/device_id_key=d1/date_part_key=2024-09-29/hour_key=10/minute_key=5"
    (file,) = folder.glob("*.json")
    body = json.loads(file.read_text())
    assert body["kwh"] == 3.0 and body["device_id"] == "d1"
    assert spark.read.json(path).count() == 2


def test_latest_objects(spark):
    row = sinks.latest_objects(readings(spark, ("d1", "2024-09-29 10:05:01", 1.0)), "minute").first()
    assert row.object_key == "d1/2024-09-29/10/5.json" and json.loads(row.json)["kwh"] == 1.0


def test_latest_log_keeps_the_newest_over_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_latest_log(readings(spark, ("d1", "2024-09-29 10:05:30", 3.0)), 0, path)
    late = readings(spark, ("d1", "2024-09-29 10:05:01", 1.0), ("d1", "2024-09-30 00:00:00", 5.0))
    for _ in range(2):
        sinks.write_latest_log(late, 1, path)
    rows = sinks.read_latest_log(spark, path, "day").collect()
    assert sorted(r.kwh for r in rows) == [3.0, 5.0]


def test_compacted_log_is_the_current_state(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(6):
        at = f"2024-09-29 10:0{(batch * 7) % 6}:01"
        sinks.write_latest_log(readings(spark, ("d1", at, float(batch)), (f"e{batch}", at, 1.0)), batch, path)
    sinks.write_latest_log(readings(spark, ("d1", "2024-09-30 10:00:00", 9.0)), 6, path)
    want = sorted(map(tuple, sinks.read_latest_log(spark, path, "hour").collect()))
    assert sinks.compact_latest_log(spark, path, "hour") == 1
    assert sorted(p.name for p in (tmp_path / "t/log_day=2024-09-29").iterdir()) == ["log_batch=5"]
    plain = spark.read.parquet(path).drop("log_day", "log_batch")
    assert sorted(map(tuple, plain.collect())) == want == sorted(map(tuple, sinks.read_latest_log(spark, path, "hour").collect()))
    assert sinks.compact_latest_log(spark, path, "hour") == 0
    sinks.write_latest_log(readings(spark, ("d1", "2024-09-29 10:59:00", 7.0)), 7, path)
    assert sinks.compact_latest_log(spark, path, "hour") == 1
    assert [r.kwh for r in spark.read.parquet(path).filter("device_id = 'd1' AND log_day = '2024-09-29'").collect()] == [7.0]


def test_fallback_takes_the_rows(spark, rows, tmp_path):
    taken = sinks.with_fallback(lambda p: sinks.write_partitioned(rows, p), "nostore://nowhere/t", str(tmp_path / "spare"))
    assert taken == str(tmp_path / "spare") and spark.read.parquet(taken).count() == 3


def test_fallback(tmp_path):
    taken = []

    def write(path):
        if path == "bad":
            raise OSError("no room")
        taken.append(path)

    assert sinks.with_fallback(write, "good", "spare") == "good"
    assert sinks.with_fallback(write, "bad", "spare") == "spare"
    assert taken == ["good", "spare"]
    with pytest.raises(OSError):
        sinks.with_fallback(write, "bad", "bad")


def test_kafka_options():
    assert kafka.kafka_options("h:9092", "meters") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "meters", "startingOffsets": "earliest", "failOnDataLoss": "true",
    }
    assert kafka.kafka_options("h", "t", max_per_trigger=500)["maxOffsetsPerTrigger"] == "500"
    chosen = kafka.kafka_options("h", "t", "latest", 10, False, "readers-1")
    assert chosen["startingOffsets"] == "latest" and chosen["failOnDataLoss"] == "false"
    assert chosen["kafka.group.id"] == "readers-1" and chosen["maxOffsetsPerTrigger"] == "10"
    assert "startingOffsets" not in kafka.kafka_options("h", "t", None)
    with pytest.raises(ValueError):
        kafka.kafka_options("h", "t", "middle")
