"""Live readings: messages to enriched rows to the latest state per device."""

import time
from datetime import datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import decode, enrich
from ..operators.latest import latest_at
from ..schemas import AREA, HOUSEHOLD
from ..sinks.files import write_batch, write_latest, write_latest_log, write_partitioned
from ..streaming.runner import run_batches

SCHEMAS = {"household": HOUSEHOLD, "area": AREA}
REQUIRED = {
    "household": ("household_id", "device_id", "timestamp"),
    "area": ("device_id", "timestamp"),
}


def marked(messages, kind):
    """Decoded messages with why a record is refused (null for good ones).

    A bad optional field becomes null; only bad required ones refuse a record.
    """
    rows = decode.decode_json(messages, SCHEMAS[kind], corrupt="raw")
    return decode.mark_valid(rows, REQUIRED[kind], corrupt="raw")


def accepted(marked_rows, kind):
    """The enriched good readings of marked rows."""
    good = marked_rows.filter("quarantine_reason IS NULL").drop("quarantine_reason", "raw")
    return enrich.enrich_household(good) if kind == "household" else enrich.enrich_area(good)


def refused(marked_rows):
    return marked_rows.filter("quarantine_reason IS NOT NULL")


def decoded(messages, kind):
    """(valid enriched readings, quarantined records) of a message table or stream."""
    rows = marked(messages, kind)
    return accepted(rows, kind), refused(rows)


def write_latest_state(batch, batch_id, path, keys=("device_id",), layout="log", tiebreak=()):
    """Latest rows of a batch at minute, hour and day grain, below ``path/grain``.

    The batch is reduced once, to the minute grain; the coarser grains and all
    three writes start from that.
    """
    minute = latest_at(batch, keys, "minute", tiebreak=tiebreak).persist()
    try:
        hour = latest_at(minute, keys, "hour", tiebreak=tiebreak)
        day = latest_at(hour, keys, "day", tiebreak=tiebreak)
        for grain, rows in {"minute": minute, "hour": hour, "day": day}.items():
            if layout == "log":
                write_latest_log(rows, batch_id, f"{path}/{grain}")
            else:
                write_latest(rows, f"{path}/{grain}", grain, keys)
    finally:
        minute.unpersist()


LOG_COLUMNS = (
    ("type", "string"), ("batch_id", "long"), ("ts", "timestamp"), ("records", "long"), ("valid", "long"),
    ("refused", "long"), ("duration_ms", "long"),
)


def process_messages(batch, batch_id, kind, path, layout="log"):
    """One micro-batch of raw messages: latest state, quarantine, progress row.

    The counts are taken while the batch is decoded, not by another pass.
    """
    begun = time.time()
    counts = Observation(f"{kind}_{batch_id}")
    good = F.col("quarantine_reason").isNull()
    rows = marked(batch, kind).observe(
        counts, F.count(F.lit(1)).alias("records"), F.count_if(good).alias("valid"),
        F.count_if(~good).alias("refused"),
    ).persist()
    try:
        write_latest_state(accepted(rows, kind), batch_id, f"{path}/{kind}", layout=layout)
        bad = refused(rows).select("raw", "quarantine_reason")
        write_batch(bad, batch_id, f"{path}/quarantine/{kind}")
    finally:
        rows.unpersist()
    seen = counts.get
    entry = (
        kind, batch_id, datetime.fromtimestamp(begun), seen["records"], seen["valid"], seen["refused"],
        round((time.time() - begun) * 1000),
    )
    # One row of literals: no Python worker, one task.
    log = batch.sparkSession.range(0, 1, 1, 1).select(*[F.lit(value).cast(of).alias(name) for value, (name, of) in zip(entry, LOG_COLUMNS, strict=True)])
    write_partitioned(
        log.withColumn("batch", F.lit(batch_id)), f"{path}/progress", ["type", "batch"],
        mode="overwrite_partitions", rebalance=False,
    )


def start(streams, path, checkpoint, process=process_messages, **run):
    """Start one query per kind of message; ``streams`` maps kinds to streams."""
    unknown = set(streams) - set(SCHEMAS)
    if unknown:
        raise ValueError(f"unknown kinds {sorted(unknown)}")
    return [
        run_batches(
            stream, process, f"{checkpoint}/{kind}", name=f"{kind}_latest",
            bound={"kind": kind, "path": path}, **run,
        )
        for kind, stream in streams.items()
    ]

