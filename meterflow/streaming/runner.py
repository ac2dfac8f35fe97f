"""Starting, watching and stopping streaming queries."""

import logging
import time
from contextlib import contextmanager

from ..checks import require_choice

log = logging.getLogger(__name__)

MODES = ("append", "update", "complete")
INTERVAL = "10 seconds"
# State in RocksDB files below the workers' local folders instead of their heaps. One bound holds for all
# partitions of a worker; a batch stores its changes in the checkpoint, whole copies follow in the background.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting rows would read every key before it is written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def _settings(session, values):
    """Settings that a query started meanwhile keeps; the session has its own again afterwards."""
    before = {key: session.conf.get(key, None) for key in values}
    for key, value in values.items():
        session.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            session.conf.unset(key) if value is None else session.conf.set(key, value)


def _start(writer, checkpoint, name, mode, interval, available_now):
    if not checkpoint:
        raise ValueError("a streaming query needs a checkpoint location")
    require_choice("output mode", mode, MODES)
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


@contextmanager
def _adaptive(session):
    """Adaptive plans for what is built on a batch: Spark turns them off for the session of a stateful
    query, and writes then drop their rebalancing: every state partition opens a file in every folder."""
    key = "spark.sql.adaptive.enabled"
    before = session.conf.get(key)
    session.conf.set(key, "true")
    try:
        yield
    finally:
        # The next batch of the query itself is planned as Spark wants it.
        session.conf.set(key, before)


def run_batches(df, process, checkpoint, name=None, mode="append", interval=INTERVAL,
                available_now=False, bound=None, stateful=None, state_on_disk=False):
    """Hand each micro-batch with rows to ``process(batch, batch_id, **bound)``.

    A failing ``process`` fails the batch, which is run again from the
    checkpoint; so its writes must replace themselves (see ``sinks``).
    ``interval=None`` starts batches as fast as they come.

    Batches of stateful queries are handed over unseen: their state is kept
    only when every partition has run, so a look at a few rows would be a second,
    partial run. ``process`` should write such a batch in one job; an empty one
    writes nothing to partitioned folders. What ``process`` builds on such a batch is planned
    adaptively, as on a table; the query itself is not. ``stateful`` defaults to update and
    complete mode; set it for append queries with a watermark, and where the
    progress counts must not hold the rows of that look.

    ``state_on_disk`` is for state of many keys: it lies in files, and memory does
    not grow with it. A checkpoint goes on with the kind of state it began with.
    """
    bound = dict(bound or {})
    if stateful is None:
        stateful = mode != "append"

    def handle(batch, batch_id):
        if not stateful and batch.isEmpty():
            log.info("%s batch %s: no data", name or "query", batch_id)
            return
        if not stateful:
            return process(batch, batch_id, **bound)
        with _adaptive(batch.sparkSession):
            process(batch, batch_id, **bound)

    with _settings(df.sparkSession, STATE_ON_DISK if state_on_disk else {}):
        return _start(df.writeStream.foreachBatch(handle), checkpoint, name, mode, interval, available_now)


def run_console(df, checkpoint, name=None, mode="append", interval=INTERVAL, available_now=False,
                rows=20):
    """Print batches untruncated, for debugging."""
    writer = df.writeStream.format("console").option("truncate", False).option("numRows", rows)
    return _start(writer, checkpoint, name, mode, interval, available_now)


def run_memory(df, name, checkpoint, mode="append", interval=None, available_now=True):
    """Collect results in an in-memory table called ``name``, for tests."""
    return _start(df.writeStream.format("memory"), checkpoint, name, mode, interval, available_now)


def run_all(queries, poll_seconds=0.2):
    """Wait until all queries end; if one fails, stop the others and raise.

    Interrupting the wait also stops every query.
    """
    queries = list(queries)
    try:
        waiting = queries
        while waiting:
            for query in waiting:
                if not query.isActive and query.exception() is not None:
                    raise query.exception()
            waiting = [q for q in waiting if q.isActive]
            if waiting:
                time.sleep(poll_seconds)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
