"""Late rows as an output of their own, counted per batch."""

import json

from pyspark.sql import functions as F

from ..checks import require_columns
from ..durable import remove_folders
from . import runner

# Watermark records that are kept: a batch that is run again needs those before it.
KEEP = 100


class Watermark:
    """The newest event time of all batches so far, less a delay, kept at ``path``.

    Every batch leaves one record of the newest time up to and including it.
    A batch reads the record before it, so running it again gives the same watermark.
    """

    def __init__(self, spark, path, ts, delay):
        self.spark, self.path, self.ts, self.delay = spark, path.rstrip("/"), ts, delay

    def _records(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(hadoop):
            return []
        names = [status.getPath().getName() for status in store.listStatus(hadoop)]
        return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))

    def before(self, batch_id):
        """(newest time of the batches before this one, the watermark) as text, None at the start."""
        earlier = [b for b in self._records() if b < batch_id]
        if not earlier:
            return None, None
        record = json.loads(self.spark.read.text(f"{self.path}/batch={earlier[-1]}").first()["value"])
        if record["newest"] is None:
            return None, None
        mark = self.spark.range(1).select((F.lit(record["newest"]).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")).cast("string"))
        return record["newest"], mark.first()[0]

    def advance(self, batch_id, newest):
        """Record the newest time up to this batch."""
        line = json.dumps({"newest": newest})
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/batch={batch_id}")
        remove_folders(self.spark, [f"{self.path}/batch={b}" for b in self._records() if b < batch_id - KEEP])


def marked(batch, ts, watermark):
    """The batch with ``late``: whether the row's time lies before the watermark (text, or None for none yet)."""
    if watermark is None:
        return batch.withColumn("late", F.lit(False))
    before = F.col(ts).cast("timestamp_ntz") < F.lit(watermark).cast("timestamp_ntz")
    return batch.withColumn("late", F.coalesce(before, F.lit(False)))


def run_with_late(df, kept, path, checkpoint, ts="timestamp", delay="1 hour", name=None, interval=runner.INTERVAL, available_now=False):
    """Hand the current rows of every batch to ``kept(rows, batch_id)`` and set the late ones aside.

    A row is late if its time is before the watermark: the newest time of all
    earlier batches less ``delay``. Rows without a time are never late. Under ``path``:
    ``late`` (the refused rows, with the watermark that refused them), ``counts`` (a row per batch:
    records, kept, late, watermark) and ``watermark``. A batch that is run
    again replaces what it wrote and sees the same watermark; so should ``kept``.
    """
    require_columns(df, ts)
    spark = df.sparkSession
    mark = Watermark(spark, f"{path}/watermark", ts, delay)

    def process(batch, batch_id):
        before, watermark = mark.before(batch_id)
        rows = marked(batch, ts, watermark).persist()
        try:
            sums = rows.agg(
                F.count("*").alias("records"), F.count_if("late").alias("late"), F.max(F.col(ts).cast("timestamp_ntz")).cast("string").alias("newest")
            ).first()
            kept(rows.where(~F.col("late")).drop("late"), batch_id)
            refused = rows.where("late").drop("late").withColumn("watermark", F.lit(watermark).cast("timestamp_ntz"))
            refused.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            counts = [(sums["records"], sums["records"] - sums["late"], sums["late"], watermark)]
            spark.createDataFrame(counts, "records long, kept long, late long, watermark string").coalesce(1).write.mode("overwrite").parquet(
                f"{path}/counts/batch_id={batch_id}"
            )
            newest = max([t for t in (before, sums["newest"]) if t is not None], default=None)
            mark.advance(batch_id, newest)
        finally:
            rows.unpersist()

    return runner.run_batches(df, process, checkpoint, name=name, interval=interval, available_now=available_now, stateful=True)


def late_rows(spark, path):
    """All refused rows so far, with ``batch_id`` and the watermark that refused them."""
    return spark.read.parquet(f"{path}/late")


def late_counts(spark, path):
    """(batch_id, records, kept, late, watermark) of every batch."""
    counts = spark.read.parquet(f"{path}/counts")
    return counts.select(F.col("batch_id").cast("long").alias("batch_id"), "records", "kept", "late", F.col("watermark").cast("timestamp_ntz").alias("watermark"))
