"""Words of a text as DataFrame expressions (no Python in the tasks)."""

import functools

from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
_BLANK = r"[ \t\n\x0B\f\r]"


def words(text):
    """Array of the words of a text column; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"{_BLANK}+")).otherwise(F.array().cast("array<string>"))


def word_count(text):
    return F.size(words(text)).cast("long")


def without(text, chars):
    """The text with every one of the given ASCII characters taken out."""
    return functools.reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text)


def row_key(df, text_col="text", id_col="doc_id"):
    """Columns that tell rows apart by content; identical rows share them."""
    return [F.coalesce(F.col(id_col).cast("string"), F.lit("\0")).alias("__id"), F.xxhash64(text_col, F.length(text_col)).alias("__h")]
