"""Partitioned, text and latest-state writes. Every write is one Spark job.

Rows are rebalanced over the partition columns first: a folder gets few files,
and a folder with most of the rows is split over several writers.
"""

import logging
import time

from pyspark.sql import functions as F

from ..checks import require_choice, require_columns
from ..durable import durable, remove_folders, work_dir
from ..functions import keys as key_functions
from ..functions.text import delimited_line, flat_columns, row_json
from ..operators.latest import grain_columns, latest_per_group
from ..skew import join_dimension

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv", "json", "orc")
MODES = ("append", "overwrite", "overwrite_partitions", "errorifexists")


def write_partitioned(df, path, keys=(), fmt="parquet", mode="append", header=True, rebalance=True):
    """Write ``df`` below ``path``, one folder per combination of ``keys``.

    ``rebalance=False`` saves the shuffle when rows already lie by folder.

    ``overwrite_partitions`` replaces only the folders that ``df`` has rows
    for, so running the same write again changes nothing.
    """
    require_choice("format", fmt, FORMATS)
    require_choice("mode", mode, MODES)
    keys = list(keys)
    require_columns(df, *keys)
    if mode == "overwrite_partitions" and not keys:
        raise ValueError("overwrite_partitions needs partition keys")
    if keys and rebalance:
        df = df.hint("rebalance", *keys)
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", header)
    if mode == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)
    return path


def write_batch(df, batch_id, path, keys=(), fmt="parquet"):
    """Append one micro-batch so that a repeated batch replaces itself."""
    tagged = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    return write_partitioned(tagged, path, [*keys, "batch_id"], fmt, "overwrite_partitions")


def write_text_lines(df, path, columns=None, sep=",", mode="append"):
    """Rows as delimited text lines; struct fields are written one by one."""
    require_choice("mode", mode, ("append", "overwrite", "errorifexists"))
    names = list(columns or df.columns)
    require_columns(df, *names)
    leaves = flat_columns(df.select(*names).schema)
    df.select(delimited_line(leaves, sep).alias("value")).write.mode(mode).text(path)
    return path


def latest_objects(df, grain, keys=("device_id",)):
    """Latest rows as (object_key, json): the content of each latest-state object."""
    parts = [*keys, *grain_columns(grain)]
    require_columns(df, *parts)
    return df.select(
        *parts, key_functions.object_key(*parts).alias("object_key"), row_json(df.columns).alias("json")
    )


def write_latest(df, path, grain, keys=("device_id",)):
    """Latest-state layout: one folder per key and time slot, whole rows as JSON.

    A slot's row replaces the one before. Folder names are the key columns with
    ``_key`` added, so the rows keep all their columns. This layout makes a
    file per device and slot; ``write_latest_log`` is the one for many devices.
    """
    parts = [*keys, *grain_columns(grain)]
    require_columns(df, *parts)
    tagged = df.withColumns({f"{c}_key": F.col(c) for c in parts})
    return write_partitioned(tagged, path, [f"{c}_key" for c in parts], "json", "overwrite_partitions")


def write_latest_log(df, batch_id, path, fmt="parquet"):
    """Latest rows of one batch as a log by day and batch; files do not grow
    with the number of devices. ``read_latest_log`` gives the current state."""
    require_columns(df, "date_part")
    tagged = df.withColumns({"log_day": F.col("date_part"), "log_batch": F.lit(batch_id).cast("long")})
    return write_partitioned(tagged, path, ["log_day", "log_batch"], fmt, "overwrite_partitions")


def read_latest_log(spark, path, grain, keys=("device_id",), ts="timestamp", tiebreak=(), schema=None):
    """The newest row per key and slot over all logged batches."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    logged = reader.parquet(path).drop("log_day", "log_batch")
    return latest_per_group(logged, [*keys, *grain_columns(grain)], ts, tiebreak)


def compact_latest_log(spark, path, grain, keys=("device_id",), ts="timestamp", tiebreak=()):
    """Fold the logged batches of every day that has several into one.

    Afterwards a day is one batch folder with one row per key and slot, however
    many batches wrote it. Returns the number of days folded.
    """
    return compact_batches(spark, path, ("log_day",), "log_batch", [*keys, *grain_columns(grain)], ts, tiebreak)


def compact_batches(spark, path, days, batch, group, ts, tiebreak=()):
    """Fold the batches of each ``days`` folder that has several; returns how many.

    Safe to run again after a failure at any point, and beside a stream that
    appends newer batches: the newest rows replace the highest batch folded, and
    only then do the older ones go. Until then readers see rows twice at
    most, which a latest-row read ignores.
    """
    days = list(days)
    logged = spark.read.parquet(path)
    listed = logged.select(*days, F.col(batch).cast("long").alias(batch)).distinct()
    spans = listed.groupBy(*days).agg(F.max(batch).alias("__last"), F.count("*").alias("__n")).filter("__n > 1")
    spans = durable(spans)
    folders = spans.count()
    if not folders:
        return 0
    old = join_dimension(logged, spans.drop("__n"), days).filter(F.col(batch) <= F.col("__last"))
    newest = latest_per_group(old.drop("__last"), list(dict.fromkeys([*days, *group])), ts, tiebreak)
    newest = join_dimension(newest.drop(batch), spans.drop("__n"), days).withColumnRenamed("__last", batch)
    # Folder names per batch and day to fold away, listed before anything changes.
    folded = listed.join(F.broadcast(spans), days).filter(F.col(batch) < F.col("__last"))
    names = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in [*days, batch]]
    gone = durable(folded.select(F.concat_ws("/", *names).alias("f")))
    staged = work_dir(spark, "compacted")
    write_partitioned(newest, staged, [*days, batch])
    rows = spark.read.schema(newest.schema).parquet(staged)
    write_partitioned(rows, path, [*days, batch], mode="overwrite_partitions")
    remove_folders(spark, [f"{path}/{r.f}" for r in gone.toLocalIterator()] + [staged])
    return folders


def with_fallback(write, primary, fallback):
    """Run ``write(path)`` on the primary path, else on the fallback path.

    Returns the path that took the data. Both must be reachable by all
    executors. If both fail, the error of the fallback is raised from the
    primary's, so that the batch fails and is run again.
    """
    try:
        write(primary)
        return primary
    except Exception as first:
        log.warning("write to %s failed, trying %s: %s", primary, fallback, first)
        try:
            write(fallback)
        except Exception as second:
            raise second from first
        return fallback


class FallbackTarget:
    """A path to write to and a spare one, for the batches of a stream.

    A primary path that failed is left alone for ``retry_seconds``: until then
    batches go to the spare path straight away, afterwards the primary is tried again.
    """

    def __init__(self, primary, fallback, retry_seconds=600.0):
        self.primary, self.fallback, self.retry_seconds = primary, fallback, retry_seconds
        self._down_until = 0.0

    def run(self, write):
        """Run ``write(path)``; returns the path that took the data."""
        if time.monotonic() < self._down_until:
            write(self.fallback)
            return self.fallback
        took = with_fallback(write, self.primary, self.fallback)
        if took != self.primary:
            self._down_until = time.monotonic() + self.retry_seconds
        return took
