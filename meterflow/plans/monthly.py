"""Running monthly usage per household, written by storage key."""

from ..checks import require_choice
from ..operators import enrich, usage
from ..operators.latest import latest_per_group
from ..sinks.files import FallbackTarget, compact_batches, with_fallback, write_batch, write_partitioned
from ..streaming.runner import run_batches
from ..streaming.state import running_profile

HOUSEHOLD_MONTH = ("household_id", "year", "month")
HOUSEHOLD_WARD_MONTH = ("household_id", "year", "month", "district", "ward")
DISTRICT_MONTH = ("district", "year", "month")
MEASURES = ("electricity_usage_kwh", "voltage")
FOLDERS = ("bucket_name", "year", "month")


def household_month(readings, measures=MEASURES):
    return usage.profile(readings, HOUSEHOLD_MONTH, measures)


def household_ward_month(readings, measures=MEASURES):
    """Monthly profile with the ward in the grain, and its storage key."""
    return enrich.with_month_key(usage.profile(readings, HOUSEHOLD_WARD_MONTH, measures))


def district_month(readings, measure="electricity_usage_kwh"):
    return usage.total(readings, DISTRICT_MONTH, measure, "total_electricity_usage")


def write_profiles(batch, batch_id, path, fallback=None, fmt="csv"):
    """Replace the folders of the keys in ``batch``; use ``fallback`` if that fails."""

    def write(target):
        write_partitioned(batch, target, FOLDERS, fmt, "overwrite_partitions")

    return with_fallback(write, path, fallback) if fallback else write(path)


def write_profile_log(batch, batch_id, path):
    """Append the changed profiles of one batch; a repeated batch replaces itself."""
    write_batch(batch, batch_id, path, ("year", "month"))


def read_profile_log(spark, path, schema=None):
    """The newest logged profile of every household, ward and month."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    newest = latest_per_group(reader.parquet(path), HOUSEHOLD_WARD_MONTH, "batch_id")
    return newest.drop("batch_id")


def compact_profile_log(spark, path):
    """Fold the batches of every month that has several into one."""
    return compact_batches(spark, path, ("year", "month"), "batch_id", HOUSEHOLD_WARD_MONTH, "batch_id")


def start(readings, path, checkpoint, fallback=None, fmt="csv", layout="log", **run):
    """Running profile of a stream of enriched readings.

    The ``log`` layout writes only changed profiles (update mode); read it with
    ``read_profile_log`` and fold it now and then with ``compact_profile_log``. A folder
    of the ``folders`` layout holds all households of its ward and month, so
    each batch must bring whole folders: complete mode, which writes everything
    again. With a ``fallback``, a store that failed is left alone for a while and
    its batches go to the fallback path; a reader of the log reads both.
    """
    require_choice("layout", layout, ("folders", "log"))
    profile = enrich.with_month_key(running_profile(readings, HOUSEHOLD_WARD_MONTH, MEASURES))
    target = FallbackTarget(path, fallback) if fallback else None

    def process(batch, batch_id):
        def write(to):
            if layout == "log":
                write_profile_log(batch, batch_id, to)
            else:
                write_profiles(batch, batch_id, to, fmt=fmt)

        target.run(write) if target else write(path)

    return run_batches(profile, process, checkpoint, mode="update" if layout == "log" else "complete", **run)
