"""Last rows per key, late rows and silence on streams of several batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterflow.sinks import files as sinks
from meterflow.streaming import history, late, runner, silence

T = dt.datetime(2024, 5, 1)


def files(spark, tmp_path, batches, schema):
    """A stream that reads each list of rows as one batch."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/file{k}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))


def test_last_n_over_late_batches(spark, tmp_path):
    rng = random.Random(1)
    schema = "k string, ts timestamp_ntz, id long, note string, v double"
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), T + dt.timedelta(minutes=rng.randrange(90)), n, rng.choice([None, "é\"", "x"]), rng.choice([None, 0.1, 1e300])) for n in range(400)]
    rows += [("b", T, 1000, "same", 1.0)] * 3 + [("b", None, 1001, "no time", 1.0)]
    rng.shuffle(rows)
    df = files(spark, tmp_path, [rows[a::4] for a in range(4)], schema)
    newest = history.last_n_stream(df, ["k"], 7, "ts", "id")
    sizes = []

    def process(batch, batch_id):
        sinks.write_batch(batch, batch_id, str(tmp_path / "out"))
        sizes.append(spark.read.parquet(str(tmp_path / "out")).where(F.col("batch_id") == batch_id).count())

    runner.run_all([runner.run_batches(newest, process, str(tmp_path / "state"), mode="update", available_now=True)])
    got = sorted(map(str, history.current_rows(spark.read.parquet(str(tmp_path / "out")), ["k"]).select(*df.columns, "rank").collect()))
    want = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k and r[1]), key=lambda r: (r[1], r[2]), reverse=True)[:7]
        want += [(*r, p) for p, r in enumerate(mine, 1)]
    assert got == sorted(map(str, spark.createDataFrame(want, f"{schema}, rank int").collect()))
    assert max(sizes) <= 3 * 7  # a batch gives n rows per key at most


def test_trim_sends_n_rows_per_key(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"k": ["a"] * 50 + [None] * 30, "at": list(range(80)), "tie": [0] * 80, "row": ["x"] * 80})
    out = pa.Table.from_batches(history._trim([batch], ["k"], 3))
    assert sorted(out["at"].to_pylist()) == [47, 48, 49, 77, 78, 79]


def test_late_rows_come_out_and_a_repeated_batch_agrees(spark, tmp_path):
    m = lambda minutes: T + dt.timedelta(minutes=minutes)
    batches = [[(1, m(0)), (2, m(100)), (3, None)], [(4, m(39)), (5, m(40)), (6, m(90))], [(7, None)], [(8, m(200)), (9, m(10))], [(10, m(139)), (11, m(140))]]
    df = files(spark, tmp_path, batches, "id long, ts timestamp_ntz")
    seen, failed = {}, []

    def keep(rows, batch_id):
        seen[batch_id] = sorted(r.id for r in rows.collect())
        if batch_id == 3 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the store went away")

    def run():
        runner.run_all([late.run_with_late(df, keep, str(tmp_path / "out"), str(tmp_path / "state"), "ts", "60 minutes", available_now=True)])

    with pytest.raises(Exception, match="went away"):
        run()
    run()
    assert seen == {0: [1, 2, 3], 1: [5, 6], 2: [7], 3: [8], 4: [11]}
    refused = {(r.id, r.batch_id, r.watermark) for r in late.late_rows(spark, str(tmp_path / "out")).collect()}
    assert refused == {(4, 1, m(40)), (9, 3, m(40)), (10, 4, m(140))}
    counts = {r.batch_id: (r.records, r.kept, r.late, r.watermark) for r in late.late_counts(spark, str(tmp_path / "out")).collect()}
    assert counts == {0: (3, 3, 0, None), 1: (3, 2, 1, m(40)), 2: (1, 1, 0, m(40)), 3: (2, 1, 1, m(40)), 4: (2, 1, 1, m(140))}


def test_only_the_last_watermark_records_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(late, "KEEP", 2)
    mark = late.Watermark(spark, str(tmp_path / "mark"), "ts", "1 hour")
    for b in range(6):
        mark.advance(b, f"2024-01-01 0{b}:00:00")
    assert mark._records() == [3, 4, 5] and mark.before(5) == ("2024-01-01 04:00:00", "2024-01-01 03:00:00")


def test_silence_closes_by_event_time(spark, tmp_path):
    m = lambda minutes: T + dt.timedelta(minutes=minutes)
    batches = [[("a", m(0)), ("a", m(50)), ("b", m(5)), (None, m(1))], [("a", m(30)), ("c", m(180))], [("a", m(200)), ("b", m(300))], [("c", m(600))]]
    df = files(spark, tmp_path, batches, "d string, ts timestamp_ntz")
    spells = silence.active_spells(df, ["d"], "ts", "1 hour", "20 minutes")
    reported = {}

    def process(batch, batch_id):
        for r in batch.collect():
            reported[r.d, r.active_from] = (r.active_to, r.readings)
        sinks.write_batch(batch, batch_id, str(tmp_path / "out"))

    query = runner.run_batches(spells, process, str(tmp_path / "state"), stateful=True, available_now=True)
    runner.run_all([query])
    assert reported == {("a", m(0)): (m(50), 3), ("b", m(5)): (m(5), 1), (None, m(1)): (m(1), 1), ("c", m(180)): (m(180), 1), ("a", m(200)): (m(200), 1), ("b", m(300)): (m(300), 1)}
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] < len(reported)  # closed spells are dropped with the next batch
    spells = {(r.d, r.silent_from, r.silent_to) for r in silence.silent_spells(spark.read.parquet(str(tmp_path / "out")), ["d"]).collect()}
    assert spells == {("a", m(50), m(200)), ("a", m(200), None), ("b", m(5), m(300)), ("b", m(300), None), ("c", m(180), None), (None, m(1), None)}
