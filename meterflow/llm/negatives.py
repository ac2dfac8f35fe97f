"""Hard negatives by threshold joins over an inverted index with norm bounds.

Entries of a vector are taken as integers, ``floor(scale * c)``; a score is the
integer inner product with an anchor, higher first, ties by the smaller id. An
anchor's positives are its first rows of the same label. For each of them the
negatives are the first rows of another label whose score lies within a window of
shares of the positive's score.

Both searches are threshold joins. A threshold starts high and is lowered for the
anchors that still lack rows, until they have enough or the threshold has reached
its end (all rows, or the window's lower edge); so every result is exact whatever the steps.
A join takes a block of anchors (bounded in bytes, broadcast) against all rows:

* Dimensions are ordered by the anchors' energy, weakest first. A row leaves its
  leading dimensions out of the index as long as their norm times the longest
  anchor stays under the block's least threshold: they cannot lift it over alone.
* Partial scores are accumulated from the strongest dimension downwards, posting
  list by posting list. A pair is dropped when its partial score plus the product
  of both remaining norms stays under the anchor's threshold.
* What is left is scored exactly.

Tasks keep the best few rows per anchor and window only, so a vector that a
third of all rows hold makes no more output than any other.

Rows with a null label, a null or empty vector, or null or non-finite entries (or
entries beyond 2**52 after scaling) take no part. Vectors meet those of the same
length only. Rows that share the anchor's id are never its positives or negatives;
other repeated rows all count, each anchor row on its own. Null ids come
last among ties and are no anchors unless the caller says so. Scores beyond a long count as its limit. Empty tables, or none with an
anchor, give no rows. Only the named columns are read, whatever the others are called.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..shipping import mapped
from .store import discard, stored

POSITIVES = 5
NEGATIVES = 3
SCALE = 256
# A negative's score in percent of its positive's.
LEAST, MOST = 50, 95
# Shares of (longest row x anchor) and of a window's upper edge at which thresholds start and go on.
POSITIVE_STEPS = (0.6, 0.4, 0.25, 0.1)
NEGATIVE_STEPS = (0.9, 0.75)
ANCHOR_BYTES = 32 << 20
LARGEST = 1 << 52
ROWS = 4096
ANCHORS = 1024
CHUNK = 16
SPARSE = 1 / 16
PAIRS = 1 << 15
KEPT = 1 << 19
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_SLACK = 1 + 1e-9


class Index:
    """Posting lists of a block of rows, without the dimensions that the norm bound covers.

    Rows are sorted by the number of leading dimensions they leave out, so the
    posting list of a dimension is the first ``listed`` rows of its column.
    """

    def __init__(self, rows, least, longest):
        norms = np.sqrt(np.cumsum(rows * rows, axis=1))
        cut = (norms * (longest * _SLACK) < least).sum(1)
        self.order = np.argsort(cut, kind="stable")
        self.rows, cut = rows[self.order], cut[self.order]
        self.before = np.concatenate([np.zeros((len(rows), 1)), norms[self.order]], axis=1)
        d = rows.shape[1]
        self.posted = np.where(np.arange(d) >= cut[:, None], self.rows, 0.0)
        self.listed = np.searchsorted(cut, np.arange(d), "right")

    def pairs(self, anchors, norms, thresholds):
        """(anchor, row, score) of all pairs that reach the anchor's threshold."""
        n, d = self.rows.shape
        total = np.zeros((len(anchors), n))
        alive = np.ones((len(anchors), n), bool)
        for end in range(d, 0, -CHUNK):
            first = max(end - CHUNK, 0)
            listed = self.listed[end - 1]
            total[:, :listed] += anchors[:, first:end] @ self.posted[:listed, first:end].T
            # What the dimensions before ``first``, and those left out of the index, can still add.
            alive = total + np.outer(norms[:, first] * _SLACK, self.before[:, first]) >= self._least(thresholds, norms, first)
            if alive.mean() <= SPARSE:
                break
        a, r = np.nonzero(alive)
        score = self._exact(anchors, a, r, alive)
        good = score >= thresholds[a]
        return a[good], self.order[r[good]], score[good]

    def _least(self, thresholds, norms, first):
        """Thresholds less what the entries from ``first`` on that are not in the index can add."""
        gap = self.rows[:, first:] - self.posted[:, first:]
        return thresholds[:, None] - norms[:, -1:] * _SLACK * np.sqrt((gap * gap).sum(1)) - 1e-6

    def _exact(self, anchors, a, r, alive):
        most = np.abs(self.before[:, -1]).max(initial=0.0) * np.sqrt((anchors * anchors).sum(1)).max(initial=0.0)
        if most >= _EXACT:
            out = [sum(int(x) * int(y) for x, y in zip(anchors[i], self.rows[j], strict=True)) for i, j in zip(a, r, strict=True)]
            return np.array([min(max(v, -_LONG), _LONG) for v in out], object)
        if alive.mean() > SPARSE:
            return (anchors @ self.rows.T)[a, r]
        out = np.empty(len(a))
        for k in range(0, len(a), PAIRS):
            out[k : k + PAIRS] = np.einsum("ij,ij->i", anchors[a[k : k + PAIRS]], self.rows[r[k : k + PAIRS]])
        return out


class Best:
    """The first ``k`` rows per group by score and id; trimmed whenever enough have gathered."""

    def __init__(self, k, id_type):
        self.k, self.fields = k, [("g", pa.int64()), ("score", pa.int64()), ("id", id_type)]
        self.tables, self.n, self.limit = [], 0, KEPT

    def add(self, group, score, ids):
        if len(group):
            self.tables.append(pa.table([pa.array(group, pa.int64()), pa.array(np.array(score).astype(np.int64)), ids], schema=pa.schema(self.fields)))
            self.n += len(group)
            if self.n > self.limit:
                self.trim()
                self.limit = max(KEPT, 2 * self.n)

    def trim(self):
        table = pa.concat_tables(self.tables) if self.tables else pa.schema(self.fields).empty_table()
        table = table.take(pc.sort_indices(table, sort_keys=[("g", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end"))
        g = table["g"].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.empty(0, int)
        place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
        self.tables = [table.filter(pa.array(place < self.k))]
        self.n = len(self.tables[0])
        return self.tables[0].combine_chunks()


class Anchors:
    """A block of anchors of one length: entries, norms of leading dimensions, labels, ids and windows.

    ``low`` and ``high`` hold the score windows of each anchor, a column each.
    """

    def __init__(self, entries, labels, ids, low, high):
        self.order = np.argsort((entries * entries).sum(0), kind="stable")
        self.entries = np.ascontiguousarray(entries[:, self.order])
        self.norms = np.concatenate([np.zeros((len(entries), 1)), np.sqrt(np.cumsum(self.entries**2, axis=1))], axis=1)
        self.labels, self.ids, self.low, self.high = labels, ids, low, high
        self.thresholds = low.min(axis=1)
        self.upper = high.max(axis=1)


def _codes(values, known):
    """Number of each value in the list ``known`` (-1: not in it)."""
    return pc.fill_null(pc.index_in(values, value_set=known, skip_nulls=False), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _search(batches, blocks, same_label, k):
    """Best rows per anchor and window: group = anchor number x windows + window."""
    best = None
    for batch in batches:
        if best is None:
            best = {size: Best(k, batch.schema.field(0).type) for size in blocks}
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
        firsts = np.concatenate([[0], np.cumsum(sizes)])
        for size, block in blocks.items():
            of_size = np.flatnonzero(sizes == size)
            for part in range(0, len(of_size), ROWS):
                at = of_size[part : part + ROWS]
                rows = values[firsts[at, None] + np.arange(size)][:, block.order].astype(float)
                ids, labels = batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))
                own, id_codes = _codes(labels, block.labels[1]), _codes(ids, block.ids[1])
                index = Index(rows, block.thresholds.min(), block.norms[:, -1].max())
                for a in range(0, len(block.entries), ANCHORS):
                    cut = slice(a, a + ANCHORS)
                    i, j, score = index.pairs(block.entries[cut], block.norms[cut], block.thresholds[cut])
                    i = i + a
                    keep = ((own[j] == block.labels[0][i]) == same_label) & (id_codes[j] != block.ids[0][i]) & (score <= block.upper[i])
                    i, j, score = i[keep], j[keep], score[keep]
                    for w in range(block.low.shape[1]):
                        inside = (score >= block.low[i, w]) & (score <= block.high[i, w])
                        best[size].add(i[inside] * block.low.shape[1] + w, score[inside], ids.take(pa.array(j[inside])))
    for size, found in (best or {}).items():
        table = found.trim()
        group = table["g"].to_numpy()
        windows = blocks[size].low.shape[1]
        keys = pa.array(blocks[size].keys[group // windows])
        yield from pa.table([keys, pa.array((group % windows).astype(np.int32)), table["score"], table["id"]], names=["key", "w", "score", "id"]).to_batches(4096)


def _join(rows, anchors, same_label, k, id_kind, label_kind):
    """(key, w, score, id): the first ``k`` rows per anchor and window, for blocks of anchors one after another.

    ``anchors``: key, id, label, x, and arrays low and high of the windows.
    """
    spark = rows.sparkSession
    size = anchors.agg(F.count("*").alias("n"), F.sum(8 * F.size("x") + 16 * F.size("low") + 64).alias("b")).first()
    if not size["n"]:
        return None
    blocks = -(-int(size["b"]) // ANCHOR_BYTES)
    found = []
    for b in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).toArrow()  # bounded by ANCHOR_BYTES
        shared = spark.sparkContext.broadcast(_blocks(part))
        hits = rows.select("id", "label", "x").transform(
            mapped, lambda it, shared=shared: _search(it, shared.value, same_label, k), f"key long, w int, score long, id {id_kind}"
        )
        place = F.row_number().over(Window.partitionBy("key", "w").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
        found.append(stored(hits.withColumn("place", place).where(F.col("place") <= k), "hits"))
        shared.unpersist()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out._parts = found
    return out


def _blocks(table):
    """Anchors by vector length from a table of anchors."""
    out = {}
    sizes = pc.list_value_length(table["x"]).to_numpy()
    for size in np.unique(sizes):
        part = table.filter(pa.array(sizes == size)).combine_chunks()
        matrix = lambda name, width: pc.list_flatten(part[name]).to_numpy().reshape(-1, width).astype(float)
        labels, ids = part["label"].combine_chunks(), part["id"].combine_chunks()
        known, known_ids = pc.unique(labels), pc.unique(ids)
        windows = len(part["low"][0])
        out[int(size)] = block = Anchors(
            matrix("x", int(size)), (_codes(labels, known), known), (_codes(ids, known_ids), known_ids), matrix("low", windows), matrix("high", windows)
        )
        block.keys = part["key"].to_numpy()
    return out


def _integers(batches, scale):
    """Usable rows with their entries as integers, in columns key, id, label, anchor, x, norm."""
    for batch in batches:
        column = batch.column(3)
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        bad = np.bincount(owner[~(np.abs(values) < LARGEST)], minlength=len(sizes)) > 0
        good = ~bad & (sizes > 0)
        norms = np.sqrt(np.bincount(owner, np.where(np.isfinite(values), values, 0) ** 2, len(sizes)))[good]
        kept = values[good[owner]].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[good])]).astype(np.int32)
        keep = pa.array(good)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep), batch.column(2).filter(keep), batch.column(4).filter(keep),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(kept)), pa.array(norms)],
            names=["key", "id", "label", "anchor", "x", "norm"],
        )


def _lowered(rows, anchors, steps, windows, enough, same_label, kinds, finish):
    """Threshold joins at falling thresholds until every window of every anchor is filled.

    ``windows(step)`` gives the (low, high) columns at a step; None is the last
    one. ``finish(hits, step)`` gives the keys and windows that need no more.
    """
    left, parts = anchors, []
    for step in (*steps, None):
        low, high = windows(step)
        hits = _join(rows, left.withColumns({"low": low, "high": high}), same_label, enough, *kinds)
        if hits is None:
            break
        done, left = finish(hits, left, step)
        parts.append(done)
        if step is not None:
            left = stored(left, "left")
    return parts


def prepare(df, is_anchor, id_col="vec_id", vector_col="embedding", label_col="label", scale=SCALE):
    """The usable rows as integers, stored: key, id, label, anchor, x, norm."""
    id_kind, label_kind = (df.schema[c].dataType.simpleString() for c in (id_col, label_col))
    picked = df.where(F.col(label_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    schema = f"key long, id {id_kind}, label {label_kind}, anchor boolean, x array<long>, norm double"
    return stored(picked.transform(mapped, lambda it: _integers(it, scale), schema), "integers")


def first_positives(rows, anchors, positives, kinds):
    """(key, place, positive_id, positive_score) of every anchor's first rows of its label."""
    longest = rows.agg(F.max("norm")).first()[0]
    window = lambda step: (
        F.array(F.lit(-float("inf")) if step is None else F.col("norm") * longest * step), F.array(F.lit(float("inf")))
    )

    def finish(hits, left, step):
        if step is None:
            return hits.join(left.select("key"), "key", "left_semi"), None
        full = hits.where(F.col("place") == positives).select("key")
        return hits.join(full, "key", "left_semi"), left.join(full, "key", "left_anti")

    parts = _lowered(rows, anchors, POSITIVE_STEPS, window, positives, True, kinds, finish)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("key", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))


def window_negatives(rows, anchors, wanted, negatives, least, most, kinds):
    """(key, place, rank, negative_id, negative_score) for the windows below each positive's score."""
    # Whole numbers s with least * p <= 100 * s <= most * p; a window without any is empty.
    edge = lambda share: F.col("positive_score").cast("decimal(20,0)") * share / 100
    spans = wanted.select("key", "place", F.ceil(edge(least)).cast("long").alias("from"), F.floor(edge(most)).cast("long").alias("to"))
    listed = stored(
        anchors.join(spans.where(F.col("from") <= F.col("to")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "from", "to"))).alias("spans")), "key"),
        "windows",
    )
    # At most ``positives`` windows per anchor; all anchors get as many columns, empty ones never match.
    widest = listed.agg(F.max(F.size("spans"))).first()[0]
    if not widest:
        return None
    nothing = F.struct(F.lit(None).cast("int").alias("place"), F.lit(None).cast("long").alias("from"), F.lit(None).cast("long").alias("to"))
    padded = F.concat("spans", F.array_repeat(nothing, F.lit(widest) - F.size("spans")))
    infinite = F.lit(float("inf"))

    def windows(step):
        lows = F.transform(
            padded,
            lambda s: F.coalesce((F.greatest(s["from"], F.floor(s["to"] * step)) if step is not None else s["from"]).cast("double"), infinite),
        )
        highs = F.transform(padded, lambda s: F.coalesce(s["to"].cast("double"), -infinite))
        return lows, highs

    def finish(hits, left, step):
        spans = left.select("key", F.posexplode("spans").alias("w", "span")).select("key", "w", "span.*")
        if step is None:
            done = spans
        else:
            full = hits.where(F.col("place") == negatives).select("key", "w")
            # A window whose lower edge was reached needs no further search either.
            reached = spans.where(F.floor(F.col("to") * step) <= F.col("from")).select("key", "w")
            done = spans.join(full.unionByName(reached).distinct(), ["key", "w"], "left_semi")
        rest = None
        if step is not None:
            open_ = spans.join(done.select("key", "w"), ["key", "w"], "left_anti")
            again = open_.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "from", "to"))).alias("spans"))
            rest = left.drop("spans", "low", "high").join(again, "key")
        hits = hits.withColumnRenamed("place", "rank").join(done.select("key", "w", "place"), ["key", "w"])
        return hits, rest

    parts = _lowered(rows, listed, NEGATIVE_STEPS, windows, negatives, False, kinds, finish)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("key", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))


def op_negatives(
    df, is_anchor, id_col="vec_id", vector_col="embedding", label_col="label",
    positives=POSITIVES, negatives=NEGATIVES, least=LEAST, most=MOST, scale=SCALE,
):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every anchor row.

    ``is_anchor`` is a boolean column of ``df``.
    """
    kinds = tuple(df.schema[c].dataType.simpleString() for c in (id_col, label_col))
    empty = f"anchor_id {kinds[0]}, positive_id {kinds[0]}, rank int, negative_id {kinds[0]}, positive_score long, negative_score long"
    rows = prepare(df, is_anchor, id_col, vector_col, label_col, scale)
    anchors = stored(rows.where("anchor").select("key", "id", "label", "x", "norm"), "anchors")
    if anchors.isEmpty():
        return df.sparkSession.createDataFrame([], empty)
    wanted = stored(first_positives(rows, anchors, positives, kinds), "positives")
    found = window_negatives(rows, anchors, wanted, negatives, least, most, kinds)
    if found is None:
        return df.sparkSession.createDataFrame([], empty)
    out = found.join(wanted, ["key", "place"]).join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
    out = stored(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives")
    discard(rows, anchors, wanted)
    return out
