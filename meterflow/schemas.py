"""Message schemas.

The field names and types below are fixed values of the wire format. Fields
are declared non-null, but ``from_json`` does not enforce that; use
``operators.decode.split_valid`` to separate records that break the promise.
"""

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields, nullable=False):
    return StructType([StructField(name, kind, nullable) for name, kind in fields])


LOCATION = _struct(
    ("house_number", StringType()),
    ("ward", StringType()),
    ("district", StringType()),
    ("city", StringType()),
)

HOUSEHOLD = _struct(
    ("type", StringType()),
    ("household_id", StringType()),
    ("device_id", StringType()),
    ("timestamp", TimestampType()),
    ("electricity_usage_kwh", FloatType()),
    ("voltage", IntegerType()),
    ("current", FloatType()),
    ("location", LOCATION),
    ("price_per_kwh", IntegerType()),
    ("total_cost", IntegerType()),
)

AREA = _struct(
    ("type", StringType()),
    ("device_id", StringType()),
    ("timestamp", TimestampType()),
    ("ward", StringType()),
    ("district", StringType()),
    ("city", StringType()),
    ("total_electricity_usage_kwh", FloatType()),
)


def without(schema, *names):
    """``schema`` minus some top-level fields (older message generations)."""
    unknown = set(names) - set(schema.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    return StructType([f for f in schema.fields if f.name not in names])


def widened(schema):
    """``schema`` with float fields as double and every field nullable."""
    out = []
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, FloatType):
            kind = DoubleType()
        elif isinstance(kind, StructType):
            kind = widened(kind)
        out.append(StructField(field.name, kind, True))
    return StructType(out)


# Older generations of the household message: no type and device id, no city.
HOUSEHOLD_V1 = StructType(
    [
        StructField("location", without(LOCATION, "city"), False)
        if f.name == "location"
        else f
        for f in without(HOUSEHOLD, "type", "device_id").fields
    ]
)
HOUSEHOLD_V1_DOUBLE = widened(HOUSEHOLD_V1)
HOUSEHOLD_V2 = without(HOUSEHOLD, "type")
