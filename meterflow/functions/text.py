"""Text encodings of rows."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Lossless time text inside JSON rows (fixed value).
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def flat_columns(schema, prefix=""):
    """Leaf column names of a schema, struct fields as dotted names."""
    names = []
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, StructType):
            names += flat_columns(field.dataType, f"{name}.")
        else:
            names.append(name)
    return names


def delimited_line(columns, sep=","):
    """Columns as text joined by ``sep``; nulls are skipped."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in columns])


def row_json(columns):
    """A row as one JSON object, times as ISO text without a zone."""
    return F.to_json(
        F.struct(*columns),
        {
            "timestampFormat": ISO_MICROS,
            "timestampNTZFormat": ISO_MICROS,
            "dateFormat": "yyyy-MM-dd",
        },
    )
