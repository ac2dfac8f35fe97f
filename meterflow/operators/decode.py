"""Message decoding: bytes to typed columns, with bad records kept apart."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..checks import require_columns

ADDRESS = ("house_number", "ward", "district")


def decode_json(df, schema, value="value", keep=(), corrupt=None):
    """Parse the JSON text or bytes in ``value`` and flatten it to columns.

    ``keep`` names input columns to carry along. With ``corrupt`` given, a
    column of that name holds the raw text of records that did not fit the
    schema in full, and null for good ones.
    """
    require_columns(df, value, *keep)
    options = {}
    if corrupt:
        schema = StructType([*schema.fields, StructField(corrupt, StringType(), True)])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = F.from_json(F.col(value).cast("string"), schema, options)
    # A generator is a barrier: later filters read its columns instead of
    # parsing the text again for each of them.
    return df.select(*keep, F.inline(F.array(parsed)))


def flatten_location(df, column="location"):
    """Nested fields of ``column`` as top-level columns in its place."""
    require_columns(df, column)
    return df.select(*[f"{c}.*" if c == column else c for c in df.columns])


def address_struct(df, fields=ADDRESS, name="address"):
    """Re-assemble address columns into one struct column."""
    require_columns(df, *fields)
    return df.withColumn(name, F.struct(*fields))


def missing_fields(df, required):
    """Column: comma-joined names of the required fields that are null, or null."""
    require_columns(df, *required)
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return F.nullif(names, F.lit(""))


def complete(required):
    """Predicate: every required field is set."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def mark_valid(df, required, corrupt=None, reason="quarantine_reason", strict=False):
    """Add why a record is refused (null for valid ones), in the same pass.

    Records that lack a required field are refused: as ``malformed`` if their
    text did not fit the schema, else with the names of the fields. A record
    with a bad optional field is kept with that field null, unless ``strict``.
    """
    why = missing_fields(df, required)
    if corrupt:
        require_columns(df, corrupt)
        bad = F.col(corrupt).isNotNull()
        why = F.when(bad & (F.lit(strict) | why.isNotNull()), F.lit("malformed")).otherwise(why)
    return df.withColumn(reason, why)


def split_valid(df, required, corrupt=None, reason="quarantine_reason", strict=False):
    """(valid rows, quarantined rows with the reason); together the whole input."""
    marked = mark_valid(df, required, corrupt, reason, strict)
    drop = [reason] + ([corrupt] if corrupt else [])
    valid = marked.filter(F.col(reason).isNull()).drop(*drop)
    return valid, marked.filter(F.col(reason).isNotNull())
