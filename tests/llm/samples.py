"""Small tables with the awkward cases, and made-up text from a few syllables."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SYLLABLES = "ka lo mi ten ru sa vor li pan du".split()
DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


def words(rng, n, most=3):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, most))) for _ in range(n)]


def text(rng, n, most=3):
    return " ".join(words(rng, n, most))


def awkward(seed=1):
    """(doc_id, text, lang, source): nulls, empty, blank, long, repeated and tied rows."""
    rng = random.Random(seed)
    body = text(rng, 60)
    long = text(rng, 30_000)
    near = body.split()
    near[30] = "changed"
    rows = [
        (0, body, "en", "a"), (1, body, "en", "a"), (2, " ".join(near), "en", "b"), (3, None, "en", "a"), (4, "", None, None),
        (5, " \t\n\x0b ", "de", "b"), (6, long, "de", "c"), (7, long + " tail", "de", "c"), (8, "one two", None, "a"),
        (9, "One TWO", "fr", None), (None, text(rng, 40), "en", "a"), (None, None, None, None), (10, body, None, "a"), (10, body, None, "a"),
        (11, body[: len(body) // 2] + "\n" + body[: len(body) // 2], "en", "b"), (11, text(rng, 45), "en", "b"),
        (12, "é ü 中文 字 " + text(rng, 25), "fr", "d"), (13, "x " * 500, "es", "d"), (14, "\n".join(words(rng, 30)), "es", "d"),
    ]
    return rows


def frame(spark, rows, **extra):
    """documents from (doc_id, text, lang, source) rows; ``extra`` adds constant columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows], DOCUMENTS).repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def space_words(value):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", value or "")
