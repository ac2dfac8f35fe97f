"""Streams give the same answers as their batch forms."""

import datetime
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from catalog import batches, streams
from meterflow.operators import enrich, latest, network, usage
from meterflow.operators.progress import summary
from meterflow.plans import live, monthly
from meterflow.sinks import files as sinks
from meterflow.sources.files import file_stream
from meterflow.streaming import progress, runner, state

SCHEMA = "device_id string, household_id string, timestamp timestamp_ntz, rid int, kwh double, voltage int"
BASE = datetime.datetime(2024, 9, 30, 20, 0)


def write_files(spark, folder, shuffled, n=240, parts=6):
    """Readings over eight hours in several files, in time order or not."""
    rng = random.Random(2)
    rows = [
        (f"d{i % 5}", f"h{i % 5}", BASE + datetime.timedelta(minutes=2 * i), i, rng.random(), 220 + i % 9)
        for i in range(n)
    ]
    if shuffled:
        rng.shuffle(rows)
    size = n // parts
    for p in range(parts):
        chunk = spark.createDataFrame(rows[p * size:(p + 1) * size], SCHEMA).coalesce(1)
        chunk.write.mode("append").parquet(folder)
    return spark.createDataFrame(rows, SCHEMA)


def source(spark, folder):
    return enrich.add_time_parts(file_stream(spark, folder, SCHEMA, max_files=1))


@pytest.fixture(scope="module", params=[False, True], ids=["ordered", "shuffled"])
def data(request, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("in"))
    return folder, enrich.add_time_parts(write_files(spark, folder, request.param))


def ids(df):
    return sorted(r.rid for r in df.collect())


def test_latest_stream_equals_batch(spark, data, tmp_path):
    folder, batch = data
    newest = state.latest_stream(source(spark, folder), ["device_id"], "hour", tiebreak=["rid"])
    for _ in range(2):  # the second run finds nothing new
        runner.run_all([runner.run_batches(
            newest, lambda b, i: sinks.write_latest_log(b, i, str(tmp_path / "log")),
            str(tmp_path / "state"), mode="update", available_now=True,
        )])
    got = sinks.read_latest_log(spark, str(tmp_path / "log"), "hour", tiebreak=["rid"])
    assert ids(got) == ids(latest.latest_at(batch, ["device_id"], "hour", tiebreak=["rid"]))


def on_disk(query):
    """Does RocksDB report on the query's state?"""
    return all(any(k.startswith("rocksdb") for k in op.customMetrics) for p in query.recentProgress for op in p.stateOperators)


def test_late_latest_keeps_its_state_on_disk(spark, sf, monkeypatch):
    seen, run_all = [], runner.run_all
    monkeypatch.setattr(runner, "run_all", lambda queries: run_all(queries) or seen.extend(queries))
    before = {key: spark.conf.get(key, None) for key in runner.STATE_ON_DISK}
    batches.stream_late_latest(spark, sf)
    assert len(seen) == 1 and len(seen[0].recentProgress) > 1 and on_disk(seen[0])
    # Other queries of the session are not concerned.
    assert {key: spark.conf.get(key, None) for key in runner.STATE_ON_DISK} == before


def test_state_on_disk_goes_on_after_a_restart(spark, tmp_path):
    folder, log = str(tmp_path / "in"), str(tmp_path / "log")
    for part in range(2):
        batch = enrich.add_time_parts(write_files(spark, folder, True, parts=4))
        newest = state.latest_stream(source(spark, folder), ["device_id"], "hour", tiebreak=["rid"])
        query = runner.run_batches(
            newest, lambda b, i: sinks.write_latest_log(b, i, log), str(tmp_path / "state"), mode="update", available_now=True,
            state_on_disk=part == 0,  # the checkpoint knows
        )
        runner.run_all([query])
        assert query.recentProgress and on_disk(query)
    got = sinks.read_latest_log(spark, log, "hour", tiebreak=["rid"])
    assert ids(got) == ids(latest.latest_at(batch, ["device_id"], "hour", tiebreak=["rid"]))


def test_latest_objects_hold_the_newest_despite_late_data(spark, data, tmp_path):
    folder, batch = data
    newest = state.latest_stream(source(spark, folder), ["device_id"], "day", tiebreak=["rid"])

    def write(rows, batch_id):
        sinks.write_latest(rows, str(tmp_path / "out"), "day")

    runner.run_all([runner.run_batches(newest, write, str(tmp_path / "s"), mode="update", available_now=True)])
    got = spark.read.json(str(tmp_path / "out"))
    assert ids(got) == ids(latest.latest_at(batch, ["device_id"], "day", tiebreak=["rid"]))


def test_expiring_latest_equals_batch_when_nothing_is_too_late(spark, data, tmp_path):
    folder, batch = data
    newest = state.latest_stream(
        source(spark, folder), ["device_id"], "hour", tiebreak=["rid"], expire_after="2 days"
    )
    runner.run_all([runner.run_batches(
        newest, lambda b, i: sinks.write_latest_log(b, i, str(tmp_path / "log")), str(tmp_path / "s"),
        mode="update", available_now=True,
    )])
    got = sinks.read_latest_log(spark, str(tmp_path / "log"), "hour", tiebreak=["rid"])
    assert ids(got) == ids(latest.latest_at(batch, ["device_id"], "hour", tiebreak=["rid"]))


def shown(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_running_profile(spark, data, tmp_path, mode):
    folder, batch = data
    keys = ["household_id", "year", "month"]
    profile = state.running_profile(source(spark, folder), keys, ["kwh"])
    seen = []

    def keep(rows, batch_id):
        seen.append({tuple(r)[:3]: r for r in rows.collect()})

    runner.run_all([runner.run_batches(profile, keep, str(tmp_path), mode=mode, available_now=True)])
    final = {}
    for part in seen:
        final = {**final, **part} if mode == "update" else part
    want = shown(usage.profile(batch, keys, ["kwh"]))
    assert sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in final.values()) == want


def test_daily_profile_with_expiry(spark, data, tmp_path):
    folder, batch = data
    profile = state.running_profile(source(spark, folder), ["device_id"], ["kwh"], "timestamp", "2 days")
    runner.run_all([runner.run_memory(profile, "daily_profile", str(tmp_path), "complete")])
    want = usage.profile(batch.withColumn("day", F.to_date("timestamp")), ["device_id", "day"], ["kwh"])
    assert shown(spark.table("daily_profile").select(*want.columns)) == shown(want)


def test_monthly_plan_writes_key_folders(spark, data, tmp_path):
    folder, batch = data
    rename = {"kwh": "electricity_usage_kwh"}
    place = {"district": F.lit("Quan 10"), "ward": F.lit("Phuong 14")}
    stream = source(spark, folder).withColumnsRenamed(rename).withColumns(place)
    runner.run_all([monthly.start(
        stream, str(tmp_path / "out"), str(tmp_path / "s"), layout="folders", available_now=True,
    )])
    assert (tmp_path / "out/bucket_name=quan-10-phuong-14-2024-9/year=2024/month=9").is_dir()
    got = spark.read.option("header", True).csv(str(tmp_path / "out"))
    want = monthly.household_ward_month(batch.withColumnsRenamed(rename).withColumns(place))
    assert got.count() == want.count() == 10
    total = spark.read.option("header", True).csv(str(tmp_path / "out")).agg(F.sum("max_voltage")).first()[0]
    assert total == want.agg(F.sum("max_voltage")).first()[0]


def test_monthly_log_keeps_the_newest_profile(spark, data, tmp_path):
    folder, batch = data
    rename = {"kwh": "electricity_usage_kwh"}
    place = {"district": F.lit("Quan 10"), "ward": F.lit("Phuong 14")}
    stream = source(spark, folder).withColumnsRenamed(rename).withColumns(place)
    runner.run_all([monthly.start(
        stream, str(tmp_path / "out"), str(tmp_path / "s"), layout="log", available_now=True,
    )])
    got = monthly.read_profile_log(spark, str(tmp_path / "out"))
    want = monthly.household_ward_month(batch.withColumnsRenamed(rename).withColumns(place))
    assert spark.read.parquet(str(tmp_path / "out")).count() > want.count()
    assert shown(got.select(*want.columns)) == shown(want)


def test_stream_static_join(spark, data, tmp_path):
    folder, _ = data
    mapping = spark.createDataFrame([("T", "d0")], "transformer_id string, device_id string")
    rows = network.assign_transformer(source(spark, folder), mapping, on=["device_id"])
    runner.run_all([runner.run_memory(rows.select("rid", "transformer_id"), "assigned", str(tmp_path))])
    counts = {r.transformer_id: r["count"] for r in spark.table("assigned").groupBy("transformer_id").count().collect()}
    assert counts == {"T": 48, "Unknown_Transformer": 192}


def test_failing_batch_stops_all_and_is_run_again(spark, data, tmp_path):
    folder, _ = data
    calls = []

    def fail_once(batch, batch_id, target):
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("store is away")
        sinks.write_batch(batch.select("rid"), batch_id, target)

    def start(name):
        return runner.run_batches(
            source(spark, folder), fail_once, str(tmp_path / name), name=name, available_now=True,
            bound={"target": str(tmp_path / "out")},
        )

    endless = runner.run_batches(
        source(spark, folder), lambda b, i: None, str(tmp_path / "other"), interval="1 second"
    )
    with pytest.raises(Exception, match="store is away"):
        runner.run_all([start("raw"), endless])
    assert not endless.isActive
    runner.run_all([start("raw")])
    assert calls[:3] == [0, 1, 1]
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 240 and rows.select("rid").distinct().count() == 240


def test_empty_batches_are_skipped(spark, data, tmp_path):
    folder, _ = data
    calls = []
    nothing = source(spark, folder).filter("rid < 0")
    runner.run_all([runner.run_batches(nothing, lambda b, i: calls.append(i), str(tmp_path), available_now=True)])
    assert calls == []


def test_runner_arguments(spark, data):
    folder, _ = data
    with pytest.raises(ValueError, match="checkpoint"):
        runner.run_batches(source(spark, folder), print, "")
    with pytest.raises(ValueError, match="output mode"):
        runner.run_batches(source(spark, folder), print, "x", mode="replace")


def test_console_and_progress(spark, data, tmp_path, capfd):
    folder, _ = data
    log = progress.ProgressLog(spark, str(tmp_path / "log"), flush_rows=2)
    spark.streams.addListener(log)
    try:
        query = runner.run_console(source(spark, folder), str(tmp_path / "s"), name="shown", available_now=True)
        runner.run_all([query])
        rows = progress.recent_progress(spark, query)
        assert rows.agg(F.sum("records")).first()[0] == 240
        assert rows.filter("type = 'shown' AND duration_ms > 0").count() == 6
        log.wait_for([query])
        assert log.table().agg(F.sum("records")).first()[0] == 240
        assert log.failures().count() == 0
    finally:
        spark.streams.removeListener(log)


def report(query, batch, rows, ts="2024-01-01T00:00:00Z"):
    return {"id": query, "name": "n", "batchId": batch, "timestamp": ts, "numInputRows": rows, "durationMs": {"triggerExecution": 1}}


def test_progress_log_forgets_nothing(spark, tmp_path):
    """More batches than any buffer holds, some reported twice."""
    log = progress.ProgressLog(spark, str(tmp_path / "log"), flush_rows=400)
    for batch in range(1500):
        log._add(progress.progress_row(report("q", batch, 2)), False)
    for batch in range(0, 1500, 100):
        log._add(progress.progress_row(report("q", batch, 3, "2024-01-01T00:00:01Z")), False)
    assert len(log._rows) < 400
    rows = log.table()
    assert rows.count() == 1500 and rows.agg(F.sum("records")).first()[0] == 3000 + 15


def test_failures_are_logged(spark, data, tmp_path):
    folder, _ = data
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)

    def fail(batch, batch_id):
        raise RuntimeError("no store")

    try:
        query = runner.run_batches(source(spark, folder), fail, str(tmp_path / "s"), name="failing", available_now=True)
        with pytest.raises(Exception, match="no store"):
            runner.run_all([query])
        for _ in range(100):
            if not log._names:
                break
            time.sleep(0.1)
        (row,) = log.failures().collect()
        assert row.type == "failing" and "no store" in row.error
    finally:
        spark.streams.removeListener(log)


def test_late_rows_past_expiry_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    # A batch drops what was late before the batch ahead of it; hence two of the 20th.
    days = [datetime.datetime(2024, 9, d, 12) for d in (1, 20, 20, 2)]
    for i, at in enumerate(days):
        spark.createDataFrame([("d", "h", at, i, 1.0, 1)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    newest = state.latest_stream(source(spark, folder), ["device_id"], "day", tiebreak=["rid"], expire_after="2 days")
    runner.run_all([runner.run_batches(
        newest, lambda b, i: sinks.write_latest_log(b, i, str(tmp_path / "log")), str(tmp_path / "s"),
        mode="update", available_now=True,
    )])
    assert ids(sinks.read_latest_log(spark, str(tmp_path / "log"), "day", tiebreak=["rid"])) == [0, 2]


def test_expiring_latest_takes_map_columns(spark, data, tmp_path):
    folder, batch = data
    tagged = source(spark, folder).withColumn("tags", F.create_map(F.lit("k"), F.col("rid")))
    newest = state.latest_stream(tagged, ["device_id"], "hour", expire_after="2 days")
    runner.run_all([runner.run_memory(newest, "tagged_latest", str(tmp_path), "update")])
    assert spark.table("tagged_latest").count() > 0


def test_append_queries_can_be_stateful(spark, data, tmp_path):
    folder, _ = data
    counted = source(spark, folder).withColumn("at", F.col("timestamp").cast("timestamp")).withWatermark("at", "1 hour")
    counted = counted.groupBy(F.window("at", "1 hour")).count()
    seen = []
    runner.run_all([runner.run_batches(
        counted, lambda b, i: seen.append(b.count()), str(tmp_path), mode="append", available_now=True, stateful=True,
    )])
    assert len(seen) >= 6 and sum(seen) > 0


def test_fixed_interval_runs_until_stopped(spark, data, tmp_path):
    folder, _ = data
    taken = []
    query = runner.run_batches(source(spark, folder), lambda b, i: taken.append(b.count()), str(tmp_path), interval="100 milliseconds")
    for _ in range(300):
        if sum(taken) == 240:
            break
        time.sleep(0.1)
    assert query.isActive and sum(taken) == 240
    query.stop()


def test_live_plan(spark, tmp_path):
    home = tmp_path / "in"
    home.mkdir()

    def message(device, at, kwh):
        return json.dumps({
            "type": "household", "household_id": device[-3:], "device_id": device, "timestamp": at,
            "electricity_usage_kwh": kwh, "voltage": 230, "current": 1.0,
            "location": {"house_number": "1", "ward": "w", "district": "d", "city": "c"},
            "price_per_kwh": 1800, "total_cost": 1,
        })

    area = json.dumps({"type": "area", "device_id": "area-HCMC-Q1", "timestamp": "2024-09-29T10:00:00Z",
                       "ward": "w", "district": "Q1", "city": "HCMC", "total_electricity_usage_kwh": 9.5})
    device = "household-HCMC-Q1-261"
    (home / "a.txt").write_text("\n".join([
        message(device, "2024-09-29T10:05:30Z", 3.0), message(device, "2024-09-29T10:05:01Z", 1.0),
        message(device, "2024-09-29T10:59:59Z", 2.0), "not json",
    ]))
    (tmp_path / "area").mkdir()
    (tmp_path / "area/a.txt").write_text(area)
    streams = {
        kind: file_stream(spark, str(folder), "value string", "text")
        for kind, folder in {"household": home, "area": tmp_path / "area"}.items()
    }
    out = str(tmp_path / "out")
    runner.run_all(live.start(streams, out, str(tmp_path / "s"), available_now=True))

    def kwh(grain):
        rows = sinks.read_latest_log(spark, f"{out}/household/{grain}", grain)
        return sorted(r.electricity_usage_kwh for r in rows.collect())

    assert kwh("minute") == [2.0, 3.0] and kwh("hour") == [2.0] and kwh("day") == [2.0]
    bad = spark.read.parquet(f"{out}/quarantine/household").collect()
    assert [r.raw for r in bad] == ["not json"]
    assert spark.read.parquet(f"{out}/area/day").first().bucket_name == "hcmc-q1"
    rows = {r.type: r for r in spark.read.parquet(f"{out}/progress").collect()}
    assert (rows["household"].records, rows["household"].valid, rows["household"].refused) == (4, 3, 1)
    assert rows["area"].records == 1 and rows["area"].duration_ms > 0
    totals = {r.type: r.records for r in summary(spark.read.parquet(f"{out}/progress")).collect()}
    assert totals == {"household": 4, "area": 1, "total": 5}
    with pytest.raises(ValueError, match="unknown kinds"):
        live.start({"city": streams["area"]}, out, "x")


def test_stateful_batches_open_few_files(spark, data, tmp_path):
    """State partitions do not each write a file into every folder, and the query's own setting stays off."""
    folder, batch = data
    newest = state.latest_stream(source(spark, folder), ["device_id"], "hour", tiebreak=["rid"])
    seen = []

    def process(rows, batch_id):
        seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        sinks.write_latest_log(rows, batch_id, str(tmp_path / "log"))

    runner.run_all([runner.run_batches(newest, process, str(tmp_path / "s"), mode="update", available_now=True)])
    files = [str(f.parent) for f in (tmp_path / "log").rglob("*.parquet")]
    assert set(seen) == {"true"} and len(files) == len(set(files))
    got = sinks.read_latest_log(spark, str(tmp_path / "log"), "hour", tiebreak=["rid"])
    assert ids(got) == ids(latest.latest_at(batch, ["device_id"], "hour", tiebreak=["rid"]))


def test_many_files_make_few_batches(spark, tmp_path):
    spark.range(400).repartition(40).write.parquet(str(tmp_path / "in"))
    seen = {}

    def process(rows, batch_id):
        seen[batch_id] = rows.count()

    stream = batches._stream(spark, str(tmp_path / "in"), "id long, part int")
    runner.run_all([runner.run_batches(stream, process, str(tmp_path / "s"), available_now=True)])
    assert batches.FILES <= len(seen) < 2 * batches.FILES and sum(seen.values()) == 400


def test_messages_are_made_by_all_cores(spark, sf, monkeypatch, tmp_path):
    """However few files hold the events, their messages lie in many partitions."""
    taken, sizes = {}, []
    monkeypatch.setattr(streams.live, "start", lambda found, *_, **__: taken.update(found) or [])
    monkeypatch.setattr(streams.sinks, "read_latest_log", lambda *_: (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        streams.stream_messages(spark, sf)

    def process(rows, batch_id):
        sizes.append((rows.rdd.getNumPartitions(), rows.count()))

    runner.run_all([runner.run_batches(taken["household"], process, str(tmp_path / "s"), available_now=True)])
    events = spark.read.parquet(f"{sf}/events.parquet").count()
    assert [n for _, n in sizes] == [events] and sizes[0][0] >= 2 * spark.sparkContext.defaultParallelism
