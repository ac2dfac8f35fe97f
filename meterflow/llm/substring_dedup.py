"""Removal of repeated passages, found at difference-cover anchors.

A passage of ``WINDOW`` words repeats if its word sequence also starts earlier:
in a document with a smaller id, or earlier in the same one. Every word under a
repeat goes. Only windows of ``ANCHOR`` words that start at a cover position
(modulo ``PERIOD``) are hashed and compared. Any two equal passages share one
such anchor, because some shift below the period puts both starts on the cover
and ``PERIOD - 1 + ANCHOR <= WINDOW``. Passages around shared anchors are then
extended to all windows of full length and compared by their hash.

Word order inside a row is the input's; null and blank texts have no words. Ids may be of any type
with an order; a null id counts as smaller than all others. Rows with the same id are the same
document for the order (equal starts are not earlier), but each row is reported.
Identical rows get identical results. Texts shorter than a window are kept whole, very long ones
are worked on whole, one at a time. An empty table gives no rows; other columns are not read, whatever
their names. Windows whose 64-bit hashes agree count as equal: among n different windows a
false match is expected n * n / 2**65 times, about once in 6 * 10**9 windows.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from ..operators.ordered import ranked
from ..shipping import mapped
from .blobs import BUCKETS_PER_PARTITION, all_blobs, bucket_of, partitions_for, rows_by_bucket, runs, unpack
from .store import stored
from .text import Words, mix, slices, whole, windows

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 is one of two members
ANCHOR = WINDOW - PERIOD + 1
FLUSH = 1 << 19  # records sorted together before they leave a task
SLICE_BYTES = 1 << 20
_NULL_ID = np.int64(-(2**63))
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_RECORD = (np.uint64, np.int64, np.int64, np.int32)  # hash, row key, id, word position


def _ids(column):
    return column.cast(pa.int64()).fill_null(int(_NULL_ID)).to_numpy(zero_copy_only=False)


def _slices(batches):
    """(ids, texts, words, word hashes, row keys) of every slice of every batch of (id, text)."""
    for batch in batches:
        ids = _ids(batch.column(0))
        for first, texts in slices(batch.column(1), SLICE_BYTES):
            own = ids[first : first + len(texts)]
            w = Words(texts)
            h = w.hashes()
            key = mix(whole(h, w.ptr) ^ mix(own.view(np.uint64) + np.uint64(1))).view(np.int64)
            yield own, texts, w, h, key


def _kept_hash(w, raw, d, drop=None):
    """sha256 of a text's kept words joined by spaces; ``drop`` flags its words."""
    a, b = w.ptr[d], w.ptr[d + 1]
    pairs = zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True)
    if drop is None:
        return hashlib.sha256(b" ".join([raw[s:e] for s, e in pairs])).hexdigest()
    return hashlib.sha256(b" ".join([raw[s:e] for (s, e), gone in zip(pairs, drop.tolist(), strict=True) if not gone])).hexdigest()


def _base(batches):
    """Row key, id, words and the hash of the whole text, as if nothing were removed."""
    for batch in batches:
        position = 0
        for _, texts, w, _, key in _slices([batch]):
            raw = w.bytes.tobytes()
            digests = [_kept_hash(w, raw, d) for d in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), batch.column(0).slice(position, len(texts)), pa.array(w.count), pa.array(digests)],
                names=["key", "id", "n_words", "sha"],
            )
            position += len(texts)


def _first_pass(batches, buckets):
    """Anchors by bucket. Those that occur twice in a flush are known to be
    shared: they go straight to their row's bucket, and one of them on."""
    held, size = [], 0
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True
    for own, _, w, h, key in _slices(batches):
        hashes = windows(h, ANCHOR)
        doc = w.text_of_word()[: len(hashes)]
        place = np.arange(len(hashes)) - w.ptr[doc]
        take = on_cover[place % PERIOD] & (w.left_in_text()[: len(hashes)] >= ANCHOR) & (w.count[doc] >= WINDOW)
        held.append((hashes[take], key[doc[take]], own[doc[take]], place[take].astype(np.int32)))
        size += int(take.sum())
        if size >= FLUSH:
            yield from _flush(held, buckets, earliest=False)
            held, size = [], 0
    yield from _flush(held, buckets, earliest=False)


def _flush(held, buckets, earliest):
    """Rows (bucket, known, data). Records with a hash of their own, and one per
    repeated hash, go to the hash's bucket. Of the repeated ones, all (anchors)
    or all but the earliest (windows) are known hits."""
    if not held:
        return
    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
    if not len(columns[0]):
        return
    order = np.lexsort((columns[3], columns[2], columns[0]))
    columns = [c[order] for c in columns]
    first, end = runs(columns[0])
    lead = np.zeros(len(columns[0]), bool)
    lead[first] = True
    hit = np.repeat(end - first > 1, end - first)
    if earliest:
        # Later than the earliest of its run, by (id, position); equal ones are not later.
        start = np.repeat(first, end - first)
        hit = (columns[2] != columns[2][start]) | (columns[3] != columns[3][start])
        lead |= ~hit
    for known, rows, by in ((False, lead, columns[0]), (True, hit, columns[1].view(np.uint64))):
        if rows.any():
            batch = rows_by_bucket(bucket_of(mix(by[rows]), buckets), [c[rows] for c in columns])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(batch.num_rows, known)), batch.column(1)], names=["bucket", "known", "data"]
            )


def _hits(batches, earliest, parts):
    """(row key, position) records by bucket of the key: anchors of repeated
    hashes, or windows that start later than an equal one."""
    open_blobs, known = [], []
    for batch in batches:
        for flag, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            (known if flag else open_blobs).append(value.as_buffer())
    h, key, own, place = unpack(open_blobs, _RECORD)
    order = np.lexsort((place, own, h))
    h, key, own, place = h[order], key[order], own[order], place[order]
    first, end = runs(h)
    if earliest:
        start = np.repeat(first, end - first)
        hit = (own != own[start]) | (place != place[start])
    else:
        hit = np.repeat(end - first > 1, end - first)
    _, known_key, _, known_place = unpack(known, _RECORD)
    key, place = np.concatenate([key[hit], known_key]), np.concatenate([place[hit], known_place])
    if len(key):
        yield rows_by_bucket(bucket_of(mix(key.view(np.uint64)), parts), [key, place])


def _places(batches):
    """One row per row key with its distinct positions in order."""
    key, place = unpack(all_blobs(batches, "data"), (np.int64, np.int32))
    if len(key):
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])])
        yield rows_by_bucket(key[fresh], [place[fresh]], names=("key", "places"), kind=np.int64)


def _texts(batches):
    """(key, id, compressed text) of the texts that hold a window."""
    pressed = zstandard.ZstdCompressor(level=1)
    for own, texts, w, _, key in _slices(batches):
        on = np.flatnonzero(w.count >= WINDOW)
        raw = w.bytes
        data = [pressed.compress(raw[w.offsets[d] : w.offsets[d + 1]].tobytes()) for d in on]
        yield pa.RecordBatch.from_arrays([pa.array(key[on]), pa.array(own[on]), pa.array(data, pa.binary())], names=["key", "own", "text"])


def _unpressed(batches):
    """(keys, ids, words, places) of (key, own, text, places) rows, in slices."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        first = 0
        texts = [press.decompress(v.as_buffer()) for v in batch.column(2)]
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= SLICE_BYTES):
                size += len(texts[last])
                last += 1
            w = Words(pa.array(texts[first:last], pa.binary()))
            lists = batch.column(3).slice(first, last - first)
            yield (
                batch.column(0).to_numpy()[first:last], batch.column(1).to_numpy()[first:last], w,
                [np.frombuffer(v.as_buffer(), np.int32) for v in lists],
            )
            first = last


def _extend(batches, buckets):
    """All full windows around shared anchors, by hash bucket."""
    held, size = [], 0
    for keys, own, w, places in _unpressed(batches):
        near = np.zeros(len(w) + 1, np.int64)
        for d, at in enumerate(places):
            # An anchor at a lies inside the windows that start from a - (WINDOW - ANCHOR) to a.
            np.add.at(near, w.ptr[d] + np.maximum(at - (WINDOW - ANCHOR), 0), 1)
            np.add.at(near, np.minimum(w.ptr[d] + at + 1, w.ptr[d + 1]), -1)
        hashes = windows(w.hashes(), WINDOW)
        take = (np.cumsum(near)[: len(hashes)] > 0) & (w.left_in_text()[: len(hashes)] >= WINDOW)
        at = np.flatnonzero(take)
        doc = w.text_of_word()[at]
        held.append((hashes[at], keys[doc], own[doc], (at - w.ptr[doc]).astype(np.int32)))
        size += len(at)
        if size >= FLUSH:
            yield from _flush(held, buckets, earliest=True)
            held, size = [], 0
    yield from _flush(held, buckets, earliest=True)


def _cut(batches, with_text):
    """(key, removed words, hash of the rest[, kept text]) of rows with repeated windows."""
    for keys, _, w, places in _unpressed(batches):
        raw = w.bytes.tobytes()
        removed, digests, kept = [], [], []
        for d, at in enumerate(places):
            n = w.count[d]
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, np.minimum(at + WINDOW, n), -1)
            gone = np.cumsum(edge)[:n] > 0
            removed.append(int(gone.sum()))
            digests.append(_kept_hash(w, raw, d, gone))
            if with_text:
                pairs = zip(w.start[w.ptr[d] : w.ptr[d + 1]].tolist(), w.end[w.ptr[d] : w.ptr[d + 1]].tolist(), gone.tolist(), strict=True)
                kept.append(b" ".join([raw[s:e] for s, e, out in pairs if not out]).decode("utf-8", "replace"))
        columns = [pa.array(keys), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        if with_text:
            columns.append(pa.array(kept, pa.string()))
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n_removed", "kept_sha", "kept_text"][: len(columns)])


def remove_repeats(df, text_col="text", id_col="doc_id", with_text=False):
    """(id, n_words, n_removed, kept_sha256[, kept_text]) for every row of ``df``.

    ``kept_text`` is null where nothing was removed.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    rows, places = df.select(F.col(id_col), F.col(text_col)), None
    if kind not in _WHOLE:
        # Other ids stand in by their place in their own order.
        named = df.select(F.col(id_col).alias("__name")).where(F.col("__name").isNotNull()).distinct()
        places = stored(ranked(named, [], ["__name"], "__place"), "places")
        rows = rows.join(places, F.col(id_col) == F.col("__name"), "left").select(F.col("__place").alias(id_col), text_col)
        kind = "bigint"
    base = stored(rows.transform(mapped, _base, f"key long, id {kind}, n_words long, sha string"), "base")
    total = base.agg(F.sum("n_words")).first()[0] or 0
    parts = partitions_for(spark, total * len(COVER) // PERIOD)
    buckets = parts * BUCKETS_PER_PARTITION
    shape = "bucket int, known boolean, data binary"

    def hits(records, earliest):
        found = records.repartition(parts, "bucket").transform(mapped, lambda it: _hits(it, earliest, parts), "bucket int, data binary")
        return found.repartition(parts, "bucket").transform(mapped, _places, "key long, places binary")

    anchors = hits(rows.transform(mapped, lambda it: _first_pass(it, buckets), shape), False)
    texts = rows.transform(mapped, _texts, "key long, own long, text binary")
    near = stored(texts.join(anchors, "key").select("key", "own", "text", "places"), "anchored")
    repeats = hits(near.transform(mapped, lambda it: _extend(it, buckets), shape), True)
    fields = "key long, n_removed long, kept_sha string" + ", kept_text string" * with_text
    cut = (
        near.select("key", "own", "text").join(repeats, "key").select("key", "own", "text", "places")
        .transform(mapped, lambda it: _cut(it, with_text), fields).dropDuplicates(["key"])
    )
    if places is not None:
        base = base.join(places, F.col("id") == F.col("__place"), "left").withColumn("id", F.col("__name"))
    return base.join(cut, "key", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha", "sha").alias("kept_sha256"), *(["kept_text"] * with_text),
    )


def op_repeats(documents):
    return remove_repeats(documents)
