"""Key filters and distinct keys."""

from pyspark.sql import functions as F

from ..checks import require_columns


def by_keys(df, **values):
    """Rows whose columns equal all the given values."""
    require_columns(df, *values)
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def on_days(df, first, last=None, ts="timestamp"):
    """Rows from the first to the last day, both included (ISO dates).

    Compares the raw event time, so that files and row groups of other days
    are not read; a filter on the day text cannot do that.
    """
    require_columns(df, ts)
    kind = df.schema[ts].dataType
    start = F.lit(first).cast("date").cast(kind)
    stop = F.date_add(F.lit(last or first).cast("date"), 1).cast(kind)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < stop))


def distinct_keys(df, *keys):
    """The distinct combinations of the key columns."""
    require_columns(df, *keys)
    return df.select(*keys).distinct()
