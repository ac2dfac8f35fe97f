"""Storage and grouping keys."""

from pyspark.sql import functions as F

# Device id layouts (fixed values).
HOUSEHOLD_DEVICE = "household-([^-]+)-([^-]+)-([^-]+)"
AREA_DEVICE = "area-([^-]+)-([^-]+).*"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _dashed(c):
    return F.regexp_replace(_col(c), " ", "-")


def _joined(sep, *parts):
    """Parts joined by ``sep``; null if any part is null."""
    pieces = []
    for part in parts:
        pieces += [F.lit(sep), part.cast("string")]
    return F.concat(*pieces[1:])


def location_key(district="district", ward="ward", house="house_number"):
    """``district-ward-house`` in lower case with blanks dashed."""
    return F.lower(_joined("-", _dashed(district), _dashed(ward), _dashed(house)))


def month_key(district="district", ward="ward", year="year", month="month"):
    """``district-ward-year-month`` in lower case; the month is not padded."""
    return F.lower(_joined("-", _dashed(district), _dashed(ward), _col(year), _col(month)))


def _from_groups(text, pattern, groups):
    text = _col(text)
    found = [F.regexp_extract(text, pattern, i) for i in range(1, groups + 1)]
    return F.when(text.rlike(pattern), F.lower(_joined("-", *found)))


def household_key(device_id="device_id"):
    """``city-district-house`` of a household device; null for other ids."""
    return _from_groups(device_id, HOUSEHOLD_DEVICE, 3)


def area_key(device_id="device_id"):
    """``city-district`` of an area device; null for other ids."""
    return _from_groups(device_id, AREA_DEVICE, 2)


def object_key(*parts):
    """``a/b/c.json`` from key columns, outermost first."""
    return F.concat(_joined("/", *[_col(p) for p in parts]), F.lit(".json"))


def key_of_path(path, prefix):
    """Object key of a path under ``prefix``; null for paths elsewhere."""
    path = _col(path)
    return F.when(path.startswith(prefix), F.substring(path, F.lit(len(prefix) + 1), F.length(path)))
