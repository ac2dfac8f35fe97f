"""Delimited, text, Parquet and listing scans, and file streams."""

from pyspark.sql import functions as F

from ..checks import require_choice

STREAM_FORMATS = ("parquet", "json", "csv", "text", "orc")


def read_delimited(spark, path, sep=",", schema=None):
    """Delimited text with a header line.

    Without ``schema`` the types are inferred, which reads the files twice.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_text(spark, path):
    return spark.read.text(path)


def read_parquet(spark, path, schema=None):
    """Parquet files. Give a schema to fix the types of partition columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json(spark, path, schema):
    return spark.read.schema(schema).json(path)


def list_objects(spark, path, glob="*"):
    """Path, size and time of every file below ``path``, contents unread."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_stream(spark, path, schema, fmt="parquet", max_files=None, **options):
    """A stream of the files arriving at ``path`` (a folder or a glob)."""
    require_choice("format", fmt, STREAM_FORMATS)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
