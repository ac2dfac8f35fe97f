"""A store that failed is left alone for a while; progress rows are flushed by time."""

import time

from meterflow.sinks.files import FallbackTarget
from meterflow.streaming import progress


def test_failed_store_is_not_tried_in_every_batch():
    tried = []

    def write(path):
        tried.append(path)
        if path == "bad":
            raise OSError("gone")

    target = FallbackTarget("bad", "spare", retry_seconds=60)
    assert [target.run(write) for _ in range(3)] == ["spare"] * 3
    assert tried == ["bad", "spare", "spare", "spare"]
    target._down_until = time.monotonic() - 1
    assert target.run(write) == "spare" and tried[-2:] == ["bad", "spare"]
    fine = FallbackTarget("good", "spare")
    assert fine.run(write) == "good"


def test_progress_is_flushed_by_time(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "log"), flush_rows=100, flush_seconds=0.2)
    row = lambda b: ("q", "t", b, "2024-01-01T00:00:00Z", 1, 1.0, 1.0, 1, None, None, None, None, None)
    log._add(row(0), False)
    assert not (tmp_path / "log").exists()
    time.sleep(0.3)
    log.onQueryIdle(None)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1 and log._since is None
    log._add(row(1), False)
    time.sleep(0.3)
    log._add(row(2), False)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 3


def test_progress_rows_hold_state_figures():
    report = {
        "id": "q", "name": "t", "batchId": 3, "timestamp": "2024-01-01T00:00:00Z", "eventTime": {"watermark": "2023-12-31T23:00:00.000Z"},
        "stateOperators": [{"numRowsTotal": 5, "memoryUsedBytes": 100, "numRowsDroppedByWatermark": 2}, {"numRowsTotal": 1, "memoryUsedBytes": 10, "numRowsDroppedByWatermark": 0}],
    }
    assert progress.progress_row(report)[-4:] == (6, 110, 2, "2023-12-31T23:00:00.000Z")
    assert progress.progress_row({"id": "q", "batchId": 0, "timestamp": "x"})[-4:] == (None, None, None, None)
