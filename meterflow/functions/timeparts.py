"""Time parts and text forms of a reading's event time.

Day and hour follow the session time zone for zoned timestamps; zone-free
timestamps are taken as they stand.
"""

from pyspark.sql import functions as F

# Text layouts (fixed values).
DAY = "yyyy-MM-dd"
STAMP = {
    "second": "yyyy-MM-dd HH-mm-ss",
    "minute": "yyyy-MM-dd HH-mm",
}
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def day_text(ts):
    return F.date_format(_col(ts), DAY)


def stamp(ts, precision="second"):
    """Sortable, path-safe stamp."""
    return F.date_format(_col(ts), STAMP[precision])


def iso_text(ts):
    return F.date_format(_col(ts), ISO)


def path_safe(text):
    """Colons and blanks replaced so that the text can name a folder."""
    return F.translate(_col(text), ": ", "--")


def day_of_stamp(text):
    """The day part of a stamp."""
    return F.substring_index(_col(text), " ", 1)


def parse_date(text, layout="MM-dd-yyyy"):
    """Date from text; null when the text does not match the layout."""
    return F.try_to_timestamp(_col(text), F.lit(layout)).cast("date")


def time_parts(ts="timestamp"):
    """The standard set of time columns, by name."""
    ts = _col(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "date_part": day_text(ts),
        "formatted_timestamp": stamp(ts),
    }
