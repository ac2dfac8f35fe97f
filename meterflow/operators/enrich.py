"""Readings with time parts, measure types and storage keys."""

from pyspark.sql import functions as F

from ..checks import require_choice, require_columns
from ..functions import keys
from ..functions.timeparts import time_parts

# Output columns per kind of reading (fixed lists of the output contract).
TIME_COLUMNS = ("formatted_timestamp", "date_part", "hour", "minute")
MEASURES = {
    "household": ("electricity_usage_kwh", "voltage", "current"),
    "area": ("total_electricity_usage_kwh",),
}
IDS = {
    "household": ("household_id", "device_id"),
    "area": ("device_id",),
}


def add_time_parts(df, ts="timestamp"):
    require_columns(df, ts)
    return df.withColumns(time_parts(ts))


def enrich_household(df, measure_type="float", measure="electricity_usage_kwh", ts="timestamp"):
    """Household readings with time parts and the measure in its type."""
    require_columns(df, measure)
    return add_time_parts(df, ts).withColumn(measure, F.col(measure).cast(measure_type))


def enrich_area(
    df, measure_type="float", measure="total_electricity_usage_kwh", ts="timestamp",
    device="device_id",
):
    """Area totals with time parts and the city-district storage key."""
    require_columns(df, measure, device)
    out = add_time_parts(df, ts).withColumn(measure, F.col(measure).cast(measure_type))
    return out.withColumn("bucket_name", keys.area_key(device))


def with_location_key(df, district="district", ward="ward", house="house_number", name="bucket_name"):
    require_columns(df, district, ward, house)
    return df.withColumn(name, keys.location_key(district, ward, house))


def with_month_key(df, district="district", ward="ward", name="bucket_name"):
    require_columns(df, district, ward, "year", "month")
    return df.withColumn(name, keys.month_key(district, ward))


def project_for(df, kind, extra=()):
    """The output columns of a kind of reading; ids are always kept."""
    require_choice("kind", kind, MEASURES)
    columns = [*IDS[kind], *extra, *MEASURES[kind], *TIME_COLUMNS]
    require_columns(df, *columns)
    return df.select(*columns)
