"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check.

A window of a document has as many words as the benchmark item it is held
against. Every window that holds a shingle of the item is counted: the
similarity is at most m / (a + b - m) for a window of a shingles, an item of b
and m places in the window with a shingle of the item. Windows whose bound is
below the threshold go; this loses none. The others and the items get 64-bit
SimHash fingerprints of their weighted shingles. Cutting fingerprints into
``RADIUS + 1`` blocks and joining on equal blocks finds every pair within
``RADIUS`` bits. Those pairs are confirmed by the exact similarity: the sum of the smaller over the
sum of the larger shingle counts, at least ``THRESHOLD``.

Words are lower-cased; shingles are five words, or the whole sequence of a
shorter item. Null, blank and short texts hold no window; null and blank items
match nothing. Repeated rows are reported once per id; repeated items each by
their own id. Empty tables give no pairs. Windows of equal similarity to an item are one pair of document
and item. Very long texts are cut into windows whole; only the named columns are
read, so others may have any name.
"""

from pyspark.sql import functions as F

from ..durable import durable
from ..skew import small_enough
from . import native

SHINGLE = 5
THRESHOLD = 0.75
# Similar pairs at the threshold differ in 11 bits on average (sd 3).
RADIUS = 28
# Shingles of the benchmark up to which they are broadcast (some 60 bytes each).
BROADCAST_SHINGLES = 500_000

_PAIR = ["__id", "__h", "__item", "__from", "__to"]


def _gram(words, at, size):
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def _grams(words, size):
    """Array of shingle hashes of an array of words (whole sequence if shorter)."""
    n = F.size(words)
    slid = F.transform(F.sequence(F.lit(0), n - size), lambda i: _gram(words, i, size))
    short = F.lit(None).cast("array<bigint>")
    for k in range(1, size):
        short = F.when(n == k, F.array(_gram(words, F.lit(0), k))).otherwise(short)
    return F.when(n >= size, slid).otherwise(F.coalesce(short, F.array().cast("array<bigint>")))


def item_grams(benchmark, item_col="item_id", text_col="text"):
    """A row per item and distinct shingle: its hash, its length and the item's words."""
    items = benchmark.select(F.col(item_col).alias("__item"), native.words(F.lower(text_col)).alias("__iw")).where(F.size("__iw") > 0)
    items = items.withColumn("__n", F.size("__iw")).withColumn("__grams", _grams(F.col("__iw"), SHINGLE))
    return items.select("__item", "__n", F.least("__n", F.lit(SHINGLE)).alias("__size"), F.explode(F.array_distinct("__grams")).alias("__gram")).distinct()


def _hits(rows, grams, sizes):
    """(row, item, place) of every shingle of a document that an item holds."""
    out = None
    for size in sizes:
        at = rows.select("__id", "__h", "__words", F.size("__words").alias("__len"), F.posexplode("__words").alias("__p", "__w"))
        at = at.where(F.col("__p") <= F.col("__len") - size)
        at = at.select("__id", "__h", "__len", "__p", _gram(F.col("__words"), F.col("__p"), size).alias("__gram"))
        part = at.join(grams.where(F.col("__size") == size), "__gram")
        out = part if out is None else out.unionByName(part)
    return out


def candidate_windows(documents, benchmark, text_col="text", id_col="doc_id", item_col="item_id", threshold=THRESHOLD):
    """Distinct (row, item, from, to) that may reach the threshold, with the window's shingle hashes."""
    grams = durable(item_grams(benchmark, item_col))
    held = {r["__size"]: r["n"] for r in grams.groupBy("__size").agg(F.count("*").alias("n")).collect()}
    rows = documents.select(
        *native.row_key(documents, text_col, id_col), F.col(id_col).alias("__doc"), native.words(F.lower(text_col)).alias("__words")
    )
    if not held:
        held = {SHINGLE: 0}
    hits = _hits(rows, F.broadcast(grams) if sum(held.values()) <= BROADCAST_SHINGLES else grams, sorted(held))
    # Every window that holds the hit whole; the hits of a row meet before the shuffle.
    reach = F.sequence(F.col("__p") + F.col("__size") - F.col("__n"), F.col("__p"))
    counted = hits.select("__id", "__h", "__len", "__item", "__n", "__size", F.explode(reach).alias("__s"))
    counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("__m"))
    start, end = F.greatest(F.lit(0), F.col("__s")), F.least(F.col("__len"), F.col("__s") + F.col("__n"))
    counted = counted.withColumn("__from", start).withColumn("__to", end)
    ours = F.col("__to") - F.col("__from") - F.col("__size") + 1
    theirs = F.col("__n") - F.col("__size") + 1
    most = F.least(F.col("__m"), ours, theirs)
    near = durable(counted.where(most / (ours + theirs - most) >= threshold - 1e-9).select(*_PAIR).distinct())
    cut = rows.join(F.broadcast(near) if small_enough(near) else near, ["__id", "__h"])
    window = F.slice(F.col("__words"), F.col("__from") + 1, F.col("__to") - F.col("__from"))
    cut = cut.select(*_PAIR, "__doc", window.alias("__window")).dropDuplicates(_PAIR)
    return cut.withColumn("__wg", _grams(F.col("__window"), SHINGLE)).drop("__window")


def fingerprint(grams):
    """64-bit SimHash of an array of shingle hashes, each counted as often as it occurs."""
    most = F.size(grams)

    def bit(b):
        ones = F.aggregate(grams, F.lit(0), lambda a, h: a + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1)).cast("int"))
        return F.when(2 * ones > most, F.lit(1)).otherwise(F.lit(0)).cast("long")

    # Bit by bit, so that one literal loop covers all 64.
    parts = [F.shiftleft(bit(b), b) for b in range(64)]
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def _blocks(print_col, radius):
    """Array of (block number, bits) covering the 64 bits in radius + 1 blocks."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    cut = [
        F.shiftrightunsigned(print_col, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) if b - a < 64 else print_col
        for a, b in zip(edges, edges[1:], strict=False)
    ]
    return F.array(*[F.struct(F.lit(k).alias("no"), c.alias("bits")) for k, c in enumerate(cut)])


def leaks(documents, benchmark, text_col="text", id_col="doc_id", item_col="item_id", threshold=THRESHOLD, radius=RADIUS):
    """(id, item id, similarity, first word, end word): the best window per row and item."""
    windows = durable(candidate_windows(documents, benchmark, text_col, id_col, item_col, threshold))
    windows = windows.withColumn("__fp", fingerprint(F.col("__wg")))
    items = benchmark.select(F.col(item_col).alias("__item"), _grams(native.words(F.lower(text_col)), SHINGLE).alias("__ig"))
    items = items.where(F.size("__ig") > 0).withColumn("__ifp", fingerprint(F.col("__ig")))
    left = windows.select(*_PAIR, "__fp", F.explode(_blocks(F.col("__fp"), radius)).alias("__block"))
    right = items.select("__item", "__ifp", F.explode(_blocks(F.col("__ifp"), radius)).alias("__block"))
    near = (
        left.join(right, ["__item", "__block"]).where(F.bit_count(F.col("__fp").bitwiseXOR(F.col("__ifp"))) <= radius)
        .select(*_PAIR).distinct()
    )
    pairs = durable(windows.select(*_PAIR, "__doc", "__wg").join(near, _PAIR))
    ours = pairs.select(*_PAIR, F.explode("__wg").alias("__gram"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    theirs = pairs.select(*_PAIR).join(items.select("__item", "__ig"), "__item").select(
        *_PAIR, F.explode("__ig").alias("__gram"), F.lit(0).alias("a"), F.lit(1).alias("b")
    )
    counted = ours.unionByName(theirs).groupBy(*_PAIR, "__gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    similar = counted.groupBy(*_PAIR).agg(
        (F.sum(F.least("a", "b")) / F.sum(F.greatest("a", "b"))).alias("similarity")
    ).where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct("similarity", "__from", "__to"), F.struct("similarity", -F.col("__from"), -F.col("__to")))
    docs = pairs.select(*_PAIR, "__doc")
    return (
        similar.join(docs, _PAIR).groupBy(F.col("__doc").alias(id_col), "__h", F.col("__item").alias(item_col)).agg(best.alias("__best"))
        .select(id_col, "__h", item_col, "__best.similarity", F.col("__best.__from").alias("first_word"), F.col("__best.__to").alias("end_word"))
    )


def drop_leaked(df, benchmark, text_col="text", id_col="doc_id"):
    """The rows of ``df`` without benchmark passages, columns unchanged."""
    found = leaks(df, benchmark, text_col, id_col).select(F.coalesce(F.col(id_col).cast("string"), F.lit("\0")).alias("__id"), "__h").distinct()
    keys = native.row_key(df, text_col, id_col)
    return df.select("*", *keys).join(found, ["__id", "__h"], "left_anti").select(*df.columns)


def op_leaks(documents, benchmark):
    found = leaks(documents, benchmark).drop("__h")
    best = F.max_by(F.struct("similarity", "first_word", "end_word"), F.struct("similarity", -F.col("first_word"), -F.col("end_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
