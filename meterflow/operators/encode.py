"""Rows as JSON text."""

from pyspark.sql import functions as F

from ..checks import require_columns
from ..functions.text import row_json
from ..skew import join_dimension


def with_row_json(df, columns=None, name="json"):
    """Each row with itself as a JSON object."""
    columns = list(columns or df.columns)
    require_columns(df, *columns)
    return df.withColumn(name, row_json(columns))


def group_json(df, keys, row_id, rows_per_array, columns=None, name="json"):
    """JSON arrays of the rows of each key group: (keys, part, rows, json).

    ``rows_per_array`` is the caller's choice. With a number, a group becomes
    ``ceil(rows / rows_per_array)`` arrays of about that size, parted by a hash
    of the unique ``row_id``; (keys, part) then name an array. With ``None``
    every group is one array, which must fit a task. Null keys form groups
    like any other.
    """
    keys = list(keys)
    columns = list(columns or df.columns)
    require_columns(df, *keys, row_id, *columns)
    rows = df.select(*keys, F.col(row_id).alias("__id"), row_json(columns).alias("__json"))
    part = F.lit(0)
    if rows_per_array is not None:
        sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / rows_per_array).cast("int").alias("__parts"))
        rows = join_dimension(rows, sizes.filter("__parts > 1"), keys, "left", null_safe=True)
        part = F.pmod(F.xxhash64("__id"), F.coalesce("__parts", F.lit(1))).cast("int")
    packed = rows.groupBy(*keys, part.alias("part")).agg(
        F.count("*").alias("rows"), F.sort_array(F.collect_list("__json")).alias("__all")
    )
    return packed.select(
        *keys, "part", "rows",
        F.concat(F.lit("["), F.concat_ws(",", "__all"), F.lit("]")).alias(name),
    )
