"""Quality rules from document statistics and cross-document line frequency.

Lines are normalised (case, spaces) and hashed together with their host. A
line that more than ``MAX_SHARE`` of a host's documents hold, and more than
``MIN_DOCS`` of them, is boilerplate and goes. A document that keeps less than
``LEAST_LEFT`` of its words is depleted and rejected. Documents shorter than
``LEAST_WORDS`` words, or with more than ``MOST_REPEATED`` percent of their
words in repeated windows, are rejected on their own statistics.

Null and empty texts have no words and are rejected as short. A null host is a
host of its own. Identical rows count as one document and get the same verdict;
rows that share an id but not the text are judged apart. Lines without a word
are ignored. A line at a limit exactly stays, as does a document. Very long texts and
lines are taken whole; empty tables give no rows. Only id, text and host are read, so other columns may
have any name. Only DataFrame functions run here.
"""

from pyspark.sql import functions as F

from ..durable import durable
from ..skew import join_dimension
from . import native

WINDOW = 8
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
MOST_REPEATED = 30
MAX_SHARE = 0.01
MIN_DOCS = 10
LEAST_LEFT = 0.5

_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _normal(line):
    return F.lower(F.btrim(F.regexp_replace(line, r"[ \t\x0B\f\r]+", " "), F.lit(native.SPACES)))


def document_stats(df, text_col="text", id_col="doc_id", host_col="source"):
    """Row key, id, host and the base statistics of every row."""
    text = F.col(text_col)
    filled = F.coalesce(text, F.lit(""))
    has_word = lambda line: F.length(F.btrim(line, F.lit(native.SPACES))) > 0
    first = df.select(
        *native.row_key(df, text_col, id_col), F.col(id_col), F.col(host_col).alias("__host"),
        (F.length(native.without(filled, native.SPACES))).cast("long").alias("word_chars"),
        F.regexp_count(filled, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.filter(F.split(filled, "\n"), has_word).alias("__lines"),
        F.transform(native.words(text), lambda w: F.xxhash64(w)).alias("__w"),
    )
    n = F.size("__w")
    at = lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(WINDOW)])
    second = first.select(
        "__id", "__h", id_col, "__host", "word_chars", "n_symbols", n.cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), at))
        .otherwise(F.array().cast("array<bigint>")).alias("__win"),
    )
    # Only texts in which a window occurs twice are sorted to find the places.
    again = F.size(F.array_distinct("__win")) < F.size("__win")
    placed = F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    third = second.withColumn("__sorted", F.when(again, F.sort_array(placed))).drop("__win")
    beside = lambda e, i: F.get("__sorted", i)["h"].eqNullSafe(e["h"])
    same = lambda e, i: beside(e, i - 1) | beside(e, i + 1)
    fourth = third.withColumn(
        "__at", F.sort_array(F.transform(F.filter("__sorted", same), lambda e: e["p"]))
    ).drop("__sorted")
    covered = F.transform(
        "__at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", i + 1) - p, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return fourth.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("__at")


def document_lines(df, text_col="text", id_col="doc_id", host_col="source"):
    """A row per row and distinct normalised line: key, host, line hash, words in all its copies."""
    host = F.coalesce(F.concat(F.lit("h"), F.col(host_col)), F.lit("-"))
    rows = df.select(
        *native.row_key(df, text_col, id_col), F.col(host_col).alias("__host"), host.alias("__hk"),
        F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("__line"),
    )
    rows = rows.select("__id", "__h", "__host", "__hk", _normal(F.col("__line")).alias("__line")).where(F.length("__line") > 0)
    return rows.select(
        "__id", "__h", "__host", F.xxhash64("__hk", "__line").alias("line_hash"),
        native.word_count(F.col("__line")).alias("words"),
    )


def frequent_lines(df, text_col="text", id_col="doc_id", host_col="source", max_share=MAX_SHARE, min_docs=MIN_DOCS):
    """(line_hash, documents) of the lines above the limits of their host."""
    lines = document_lines(df, text_col, id_col, host_col)
    # One row per document and line, combined before the shuffle; the count follows on the line alone.
    per_line = (
        lines.groupBy("line_hash", "__id", "__h").agg(F.first("__host").alias("__host"))
        .groupBy("line_hash").agg(F.count("*").alias("documents"), F.first("__host").alias("__host"))
        .where(F.col("documents") > min_docs)
    )
    hosts = (
        df.select(*native.row_key(df, text_col, id_col), F.col(host_col).alias("__h2")).distinct()
        .groupBy("__h2").agg(F.count("*").alias("of"))
    )
    return (
        per_line.join(hosts, F.col("__host").eqNullSafe(F.col("__h2")))
        .where(F.col("documents") > F.col("of") * max_share).select("line_hash", "documents")
    )


def judge(df, text_col="text", id_col="doc_id", host_col="source", max_share=MAX_SHARE, min_docs=MIN_DOCS):
    """Statistics and verdict per row, with ``words_left`` after boilerplate lines went."""
    frequent = durable(frequent_lines(df, text_col, id_col, host_col, max_share, min_docs))
    lost = (
        join_dimension(document_lines(df, text_col, id_col, host_col), frequent.select("line_hash"), ["line_hash"])
    )
    # Copies of a line inside a row add up; identical rows repeat the same sum, so it is divided out.
    copies = df.groupBy(*native.row_key(df, text_col, id_col)).agg(F.count("*").alias("__rows"))
    lost = lost.groupBy("__id", "__h").agg(F.sum("words").alias("__lost"), F.count("*").alias("__lines_lost"))
    stats = document_stats(df, text_col, id_col, host_col)
    lost = lost.join(copies, ["__id", "__h"]).select(
        "__id", "__h", (F.col("__lost") / F.col("__rows")).cast("long").alias("__lost"),
        (F.col("__lines_lost") / F.col("__rows")).cast("long").alias("__lines_lost"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(F.col("__lost"), F.lit(0))
    return (
        stats.join(lost, ["__id", "__h"], "left")
        .withColumn("base_failed", failed)
        .withColumn("words_left", left)
        .withColumn("lines_removed", F.coalesce("__lines_lost", F.lit(0)).cast("long"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("words_left") >= LEAST_LEFT * F.col("n_words")))
        .drop("__lost", "__lines_lost")
    )


def remove_lines(df, frequent, text_col="text", host_col="source"):
    """``df`` with the lines listed in ``frequent`` (line_hash) cut from its texts."""
    host = F.coalesce(F.concat(F.lit("h"), F.col(host_col)), F.lit("-"))
    lines = df.select(
        *native.row_key(df, text_col), host.alias("__hk"), F.explode(F.array_distinct(F.split(text_col, "\n"))).alias("__line")
    ).withColumn("line_hash", F.xxhash64("__hk", _normal(F.col("__line"))))
    found = (
        join_dimension(lines, frequent.select("line_hash").distinct(), ["line_hash"])
        .groupBy("__id", "__h").agg(F.collect_set("__line").alias("__cut"))
    )
    keys = native.row_key(df, text_col)
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda x: ~F.array_contains("__cut", x)), "\n")
    return (
        df.select("*", *keys).join(found, ["__id", "__h"], "left")
        .withColumn(text_col, F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(kept))
        .select(*df.columns)
    )


def op_rules(documents):
    return judge(documents).select("doc_id", *_STATS, "base_failed", "kept", "words_left", "lines_removed")
