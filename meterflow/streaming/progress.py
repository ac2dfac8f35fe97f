"""Progress of streaming queries as rows of an append-only table."""

import json
import threading
import time

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "query_id string, type string, batch_id long, ts string, records long, input_rate double, "
    "processing_rate double, duration_ms long, error string, state_rows long, state_bytes long, late_rows long, watermark string"
)


def progress_row(progress):
    """One batch's progress (a mapping or a progress object) as a tuple.

    The state figures are sums over the query's stateful operators: rows and bytes
    held, and rows that came too late for them; null for a query without state.
    """
    if not isinstance(progress, dict):
        progress = json.loads(progress.json)
    state = progress.get("stateOperators") or []

    def summed(name):
        return sum(operator.get(name) or 0 for operator in state) if state else None

    return (
        str(progress.get("id")),
        progress.get("name"),
        progress["batchId"],
        progress["timestamp"],
        progress.get("numInputRows", 0),
        float(progress.get("inputRowsPerSecond") or 0.0),
        float(progress.get("processedRowsPerSecond") or 0.0),
        progress.get("durationMs", {}).get("triggerExecution", 0),
        None,
        summed("numRowsTotal"),
        summed("memoryUsedBytes"),
        summed("numRowsDroppedByWatermark"),
        (progress.get("eventTime") or {}).get("watermark"),
    )


def recent_progress(spark, query):
    """A query's last batches. Spark keeps a bounded number of them: this is for
    a look at the present; totals come from ``read_progress``."""
    return spark.createDataFrame([progress_row(p) for p in query.recentProgress], SCHEMA)


class ProgressLog(StreamingQueryListener):
    """Appends every batch and failure of a session's queries to a table at ``path``.

    Rows wait in memory until ``flush_rows`` of them are there, the first has waited for
    ``flush_seconds`` when another report comes, a query ends or ``flush`` is called; then they
    are written and forgotten. A batch that is
    run again, or reported again, is one row when read.
    """

    def __init__(self, spark, path, flush_rows=100, flush_seconds=60.0):
        self.spark, self.path, self.flush_rows, self.flush_seconds = spark, path, flush_rows, flush_seconds
        self._since = None
        self._rows, self._lock, self._names, self._last = [], threading.Lock(), {}, {}

    def _add(self, row, write):
        with self._lock:
            self._rows.append(row)
            self._since = self._since or time.monotonic()
            write = write or len(self._rows) >= self.flush_rows or time.monotonic() - self._since >= self.flush_seconds
        if write:
            self.flush()

    def onQueryStarted(self, event):
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event):
        row = progress_row(event.progress)
        self._last[row[0]] = row[2]
        self._add(row, False)

    def onQueryIdle(self, event):
        # An idle query reports too: rows never wait much longer than ``flush_seconds``.
        if self._since is not None and time.monotonic() - self._since >= self.flush_seconds:
            self.flush()

    def onQueryTerminated(self, event):
        name = self._names.pop(str(event.id), None)
        if event.exception:
            self._add((str(event.id), name, None, None, 0, 0.0, 0.0, 0, event.exception, None, None, None, None), True)
        else:
            self.flush()

    def wait_for(self, queries, seconds=30):
        """Wait until the last batch of every ended query has been reported."""
        until = time.time() + seconds
        for query in queries:
            last = query.lastProgress
            while last is not None and self._last.get(str(query.id), -1) < last["batchId"]:
                if time.time() > until:
                    raise TimeoutError(f"no report of batch {last['batchId']} of {query.name}")
                time.sleep(0.05)

    def flush(self):
        """Write the waiting rows; they stay if the write fails."""
        with self._lock:
            if not self._rows:
                return
            self.spark.createDataFrame(self._rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self._rows, self._since = [], None

    def table(self):
        """One row per batch so far: the log the ``operators.progress`` functions read."""
        self.flush()
        return read_progress(self.spark, self.path)

    def failures(self):
        """(query_id, type, error) of the queries that failed."""
        self.flush()
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        return rows.filter(F.col("error").isNotNull()).select("query_id", "type", "error")


def read_progress(spark, path):
    """One row per query and batch over all that was logged; the last report of a batch counts."""
    rows = spark.read.schema(SCHEMA).parquet(path).filter(F.col("batch_id").isNotNull())
    rest = [f for f in rows.columns if f not in ("query_id", "batch_id")]
    last = F.max_by(F.struct(*rest), F.struct("ts", "duration_ms")).alias("r")
    return rows.groupBy("query_id", "batch_id").agg(last).select("query_id", "batch_id", "r.*").drop("error")
