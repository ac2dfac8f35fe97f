"""Shingle Jaccard join with signature trees.

Two documents link when their sets of word shingles have a Jaccard similarity of
at least 3/4. Documents with equal sets form one class and are joined
once. The rest goes in exact steps:

* Linked sets share a shingle among the first quarter of either, in any common
  order. Classes meet in a group per such shingle; shingles that a sample of
  the classes shows to repeat come last in the order, so that a passage many
  documents share makes no groups of its own.
* Groups with the same members are looked at once. From groups of a class's
  very first shingles a few pairs whose sizes and bitmaps allow a link are checked at once, and linked classes get
  a common label; then a few pairs across labels. That settles large families.
* Large groups that begin with the same class, in an order by hash, are searched
  as one where that takes no more pairs: the groups of a family hold much the same classes.
* In every group that still holds several labels a signature tree is built:
  leaves hold classes close in size, inner nodes the OR of their bitmaps and
  their size range. Pairs of nodes are followed down together, and dropped if the
  sizes, the bitmaps' largest possible overlap or the labels rule out a new link.
  Bitmaps of a large group are made for it: the shingles that most of its classes
  hold have a bit of their own.
* Remaining pairs are compared shingle by shingle: those of large groups at once
  and only while their labels are apart, those of others one by one.

Words are lower-cased (A-Z). A text of fewer words than a shingle is one shingle;
null and blank texts have an empty set and link with nothing. Repeated rows
share a class, so ids of equal texts link. A null id counts as larger than all
others and becomes a component id only where no other is there. Documents at exactly 3/4 link. Very long
texts are compared whole; empty tables give no rows; columns other than id and text are not
read, whatever their names. Classes and shingles are told apart by 64-bit hashes: among n different ones a
false match is expected n * n / 2**65 times. The links given out are a spanning set: every class is linked
to its component through some of its links, copies through their class.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from ..durable import durable
from ..shipping import mapped
from .blobs import BUCKETS_PER_PARTITION, all_blobs, bucket_of, partitions_for, rows_by_bucket, runs, unpack
from .components import components
from .store import discard, stored
from .text import Words, mix, per_text_sum, slices, whole, windows

SHINGLE = 5
SLICE_BYTES = 1 << 19  # of text that a task works on at a time
FLUSH = 1 << 19
LEADS = 3  # first shingles whose groups are searched for large families
SAMPLE = 8  # one class in so many shows which shingles are common
COMMON = 2  # occurrences in the sample
COMMON_SHINGLES = 500_000  # most of them that are put last (a plan choice, not a limit)
FAMILY = 64  # classes of a family compared with one of them
LARGE = 128  # members of a group from which its open pairs are compared where they are found
BLOCK = 4096  # members of a group handled together
PIECE_SHINGLES = 4_000_000  # of the members handled together, about
BITS = 4096  # of a bitmap made for a group
LEAF = 32
FAN = 8
_TOP = np.uint64(1 << 63)
_LOW = np.uint64((1 << 63) - 1)


class Sets:
    """Distinct shingles of the texts of a slice: ``keys`` sorted within each
    text, text d holding those from ``ptr[d]`` to ``ptr[d + 1]``."""

    def __init__(self, texts, common=None):
        w = Words(texts)
        h = w.hashes(lower=True)
        keys = windows(h, SHINGLE)
        ok = w.left_in_text()[: len(keys)] >= SHINGLE
        doc = w.text_of_word()[: len(keys)][ok]
        keys = keys[ok]
        short = np.flatnonzero((w.count > 0) & (w.count < SHINGLE))
        keys = np.concatenate([keys, whole(h, w.ptr)[short]]) & _LOW
        doc = np.concatenate([doc, short])
        if common is not None and len(common) and len(keys):
            at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
            keys = np.where(common[at] == keys, keys | _TOP, keys)
        order = np.lexsort((keys, doc))
        keys, doc = keys[order], doc[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        self.keys, self.doc = keys[fresh], doc[fresh]
        self.ptr = np.searchsorted(self.doc, np.arange(len(w.count) + 1))
        self.n = np.diff(self.ptr)
        plain = mix((self.keys & _LOW) + np.uint64(1))
        # Order-free hash of the set; 0 stands for the empty set.
        self.cls = np.where(self.n > 0, mix(per_text_sum(plain, self.ptr) ^ mix(self.n.astype(np.uint64))) | np.uint64(1), 0).astype(np.uint64).view(np.int64)


def _profile(batches):
    """(id, h, n, cls) of every row; with the first row of a class in a task its bitmap and compressed text."""
    press, seen = zstandard.ZstdCompressor(level=1), set()
    for batch in batches:
        for first, texts in slices(batch.column(2), SLICE_BYTES):
            s = Sets(texts)
            bits, data = [None] * len(s.n), [None] * len(s.n)
            for d in np.flatnonzero(s.n > 0).tolist():
                if s.cls[d] not in seen:
                    seen.add(s.cls[d])
                    bits[d] = _bitmap(s.keys[s.ptr[d] : s.ptr[d + 1]]).tobytes()
                    data[d] = press.compress(texts[d].as_buffer())
            kept = [batch.column(k).slice(first, len(texts)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(s.n), pa.array(s.cls), pa.array(bits, pa.binary()), pa.array(data, pa.binary())], names=["id", "h", "n", "cls", "bits", "text"]
            )


def _pressed_slices(batches):
    """The compressed texts of a column as string-like arrays of about SLICE_BYTES."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        held, size = [], 0
        for value in batch.column(0):
            held.append(press.decompress(value.as_buffer()))
            size += len(held[-1])
            if size >= SLICE_BYTES:
                yield pa.array(held, pa.binary())
                held, size = [], 0
        if held:
            yield pa.array(held, pa.binary())


def _sampled(batches, buckets):
    """The shingles of the classes by bucket."""
    held, size = [], 0
    for texts in _pressed_slices(batches):
        s = Sets(texts)
        held.append((s.keys, s.cls[s.doc]))
        size += len(s.keys)
        if size >= FLUSH:
            yield _dealt(held, buckets)
            held, size = [], 0
    if size:
        yield _dealt(held, buckets)


def _repeated(batches):
    """(shingle, classes) of the sampled shingles that several classes hold."""
    key, cls = unpack(all_blobs(batches, "data"), (np.uint64, np.int64))
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    first, end = runs(key[fresh])
    on = end - first >= COMMON
    yield pa.RecordBatch.from_arrays([pa.array(key[fresh][first[on]].view(np.int64)), pa.array((end - first)[on])], names=["key", "n"])


def _common(classes, shingles):
    """The most common shingles of the sample, at most COMMON_SHINGLES, sorted."""
    parts = partitions_for(classes.sparkSession, shingles // SAMPLE)
    some = classes.where(F.pmod(F.xxhash64("cls"), F.lit(SAMPLE)) == 0).select("text")
    posted = some.transform(mapped, lambda it: _sampled(it, parts), "bucket int, data binary")
    counted = posted.repartition(parts, "bucket").transform(mapped, _repeated, "key long, n long")
    top = counted.orderBy(F.desc("n"), "key").limit(COMMON_SHINGLES).select("key").toArrow()
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def _postings(batches, buckets, common):
    """(shingle, class, is it one of the first) records of every class's prefix, by bucket."""
    held, size = [], 0
    for texts in _pressed_slices(batches):
        s = Sets(texts, common)
        prefix = s.n - (3 * s.n + 3) // 4 + 1
        rank = np.arange(len(s.keys)) - s.ptr[s.doc]
        take = rank < prefix[s.doc]
        held.append((s.keys[take], s.cls[s.doc[take]], (rank[take] < LEADS).astype(np.uint8)))
        size += int(take.sum())
        if size >= FLUSH:
            yield _dealt(held, buckets)
            held, size = [], 0
    if size:
        yield _dealt(held, buckets)


def _dealt(held, buckets):
    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
    return rows_by_bucket(bucket_of(mix(columns[0]), buckets), columns)


def _groups(batches):
    """Distinct member lists of the shingles that several classes hold."""
    blobs = [value.as_buffer() for batch in batches for value in batch.column(1)]
    key, cls, lead = unpack(blobs, (np.uint64, np.int64, np.uint8))
    order = np.lexsort((cls, key))
    key, cls, lead = key[order], cls[order], lead[order]
    # Copies in different tasks repeat a record; keep whether any was a lead.
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (cls[1:] == cls[:-1])
    key, cls, lead = key[~same], cls[~same], lead[~same]
    first, end = runs(key)
    several = end - first > 1
    first, end = first[several], end[several]
    if not len(first):
        return
    size = end - first
    at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    cls, lead = cls[at], lead[at]
    ptr = np.concatenate([[0], np.cumsum(size)])
    gid = whole(mix(cls.view(np.uint64)), ptr)
    leads = per_text_sum(lead.astype(np.int64), ptr) > 0
    _, chosen, back = np.unique(gid, return_index=True, return_inverse=True)
    any_lead = np.zeros(len(chosen), bool)
    np.logical_or.at(any_lead, back.ravel(), leads)
    out = []
    for g, flag in zip(chosen.tolist(), any_lead.tolist(), strict=True):
        members = cls[ptr[g] : ptr[g + 1]]
        if len(members) <= BLOCK:
            out.append((int(gid[g].view(np.int64)), flag, members.tobytes()))
            continue
        # A large group becomes pairs of blocks, so that none is held whole.
        blocks = [members[k : k + BLOCK // 2] for k in range(0, len(members), BLOCK // 2)]
        for i in range(len(blocks)):
            for j in range(i + 1, len(blocks)):
                own = mix(np.array([gid[g]]) + np.uint64(i * len(blocks) + j + 1))[0]
                out.append((int(own.view(np.int64)), flag, np.concatenate([blocks[i], blocks[j]]).tobytes()))
        if len(out) > 1000:
            yield _group_rows(out)
            out = []
    if out:
        yield _group_rows(out)


def _group_rows(out):
    g, flag, data = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(flag), pa.array(data, pa.binary())], names=["gid", "lead", "members"])


def _first_pairs(batches):
    """Pairs of groups of two, and of the families in lead groups: each with one of its FAMILY neighbours."""
    for batch in batches:
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for flag, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            m = np.frombuffer(value.as_buffer(), np.int64)
            if len(m) == 2 or flag:
                head = np.arange(1, len(m))
                # The head of each family is compared with the one before.
                to = np.where(head % FAMILY == 0, head - FAMILY, head - head % FAMILY)
                left.append(m[to])
                right.append(m[head])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])


def _members(batches):
    for batch in batches:
        sizes = [len(v.as_buffer()) // 8 for v in batch.column(1)]
        flat = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64))],
            names=["gid", "cls"],
        )


def _keyed_members(batches):
    """(gid, key, m, cls): the members of groups with the group's size and its first member in an order by hash."""
    for batch in batches:
        gid, key, size, flat = [], [], [], [np.empty(0, np.int64)]
        for g, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            m = np.frombuffer(value.as_buffer(), np.int64)
            gid.append(g)
            key.append(m[np.argmin(mix(m.view(np.uint64)))])
            size.append(len(m))
            flat.append(m)
        size = np.array(size, np.int64)
        columns = [np.repeat(np.array(c, np.int64), size) for c in (gid, key, size)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in [*columns, np.concatenate(flat)]], names=["gid", "key", "m", "cls"])


def _bitmap(keys):
    """One bit per shingle in the next power of two of the set's size, 64 at least."""
    width = max(64, 1 << int(len(keys) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(keys & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def _within_bounds(batches):
    """The (a, b) pairs that sizes and bitmaps do not rule out."""
    for batch in batches:
        n, m = (batch.column(k).to_numpy() for k in (2, 3))
        keep = 4 * np.minimum(n, m) >= 3 * np.maximum(n, m)
        for r in np.flatnonzero(keep).tolist():
            x, y = (np.frombuffer(batch.column(k)[r].as_buffer(), np.uint64) for k in (4, 5))
            width = min(len(x), len(y))
            x, y = _fold(x, width), _fold(y, width)
            most = min(n[r] - _ones(x), m[r] - _ones(y)) + _ones(x & y)
            keep[r] = 7 * most >= 3 * (n[r] + m[r])
        yield batch.filter(pa.array(keep)).select([0, 1])


def _similar(pairs, texts):
    """Which (left, right) pairs of classes are similar enough, from {class: text}."""
    place = {c: k for k, c in enumerate(texts)}
    s = Sets(pa.array(list(texts.values()), pa.binary()))
    out = []
    for a, b in pairs:
        out.append(_enough(*(s.keys[s.ptr[place[c]] : s.ptr[place[c] + 1]] for c in (a, b))))
    return out


def _enough(x, y):
    """100 * shared >= 75 * union for two sorted sets."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= 75 * (len(x) + len(y) - shared)


def _linked(batches):
    """The pairs whose sets are similar enough: 100 * shared >= 75 * union."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        left, right = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep, pairs, texts, size = [], [], {}, 0
        for r, pair in enumerate(zip(left, right, strict=True)):
            for c, column in zip(pair, (2, 3), strict=True):
                if c not in texts:
                    texts[c] = press.decompress(batch.column(column)[r].as_buffer())
                    size += len(texts[c])
            pairs.append(pair)
            if size >= SLICE_BYTES:
                keep += _similar(pairs, texts)
                pairs, texts, size = [], {}, 0
        if pairs:
            keep += _similar(pairs, texts)
        yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])


def verified(pairs, texts):
    """The (a, b) pairs that link, compared on their whole texts."""
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").transform(mapped, _linked, "a long, b long")


class Node:
    """A tree node over rows ``lo`` to ``hi`` of a group sorted by size."""

    __slots__ = ("lo", "hi", "children", "bits", "least", "most", "slack", "label")

    def __init__(self, lo, hi, children, bits, least, most, slack, label):
        self.lo, self.hi, self.children, self.bits = lo, hi, children, bits
        self.least, self.most, self.slack, self.label = least, most, slack, label


def _fold(bits, width):
    """Bitmaps (last axis: 64-bit words) brought down to ``width`` words."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _ones(bits):
    return np.bitwise_count(bits).sum(-1, dtype=np.int64)


def shared_bitmaps(sets):
    """(held, bits): how many shingles of each set another one holds too, and a
    bitmap of these, of one width for all sets. The most frequent have a bit of
    their own, as have all where BITS are enough; the others share bits."""
    keys, times = np.unique(np.concatenate(sets), return_counts=True)
    keys, times = keys[times > 1], times[times > 1]
    bit = np.empty(len(keys), np.int64)
    bit[np.argsort(-times, kind="stable")] = np.arange(len(keys))
    width = min(BITS, max(64, 1 << max(0, len(keys) - 1).bit_length()))
    if len(keys) > width:
        half = width // 2
        bit = np.where(bit < half, bit, half + bit % half)
    held, bits = np.zeros(len(sets), np.int64), np.zeros((len(sets), width), np.uint8)
    for k, own in enumerate(sets if len(keys) else ()):
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        at = at[keys[at] == own]
        held[k] = len(at)
        bits[k, bit[at]] = 1
    return held, np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def signature_tree(n, bits, labels, held=None):
    """Root over rows sorted by size. ``bits``: a word array per row, of ``held`` shingles (all, if not given)."""
    held = n if held is None else held
    level = []
    for lo in range(0, len(n), LEAF):
        hi = min(lo + LEAF, len(n))
        width = min(len(b) for b in bits[lo:hi])
        own = np.stack([_fold(b, width) for b in bits[lo:hi]])
        label = labels[lo] if (labels[lo:hi] == labels[lo]).all() else None
        # A set has at most this many more shingles than bits.
        slack = int((held[lo:hi] - _ones(own)).max())
        level.append(Node(lo, hi, None, own, int(n[lo]), int(n[hi - 1]), slack, label))
    tops = [(node, np.bitwise_or.reduce(node.bits, axis=0)) for node in level]
    while len(tops) > 1:
        above = []
        for k in range(0, len(tops), FAN):
            part = tops[k : k + FAN]
            width = min(len(b) for _, b in part)
            union = np.bitwise_or.reduce(np.stack([_fold(b, width) for _, b in part]), axis=0)
            # Folding merges bits, which may raise the slack to the whole size.
            slack = max(node.slack if len(b) == width else node.most for node, b in part)
            label = part[0][0].label if all(node.label is not None and node.label == part[0][0].label for node, _ in part) else None
            above.append((Node(part[0][0].lo, part[-1][0].hi, part, union, part[0][0].least, part[-1][0].most, slack, label), union))
        tops = above
    return tops[0]


def _may_link(x, ux, y, uy):
    """Could a set under x link with one under y and join two labels?"""
    if x.label is not None and x.label == y.label:
        return False
    if 4 * min(x.most, y.most) < 3 * max(x.least, y.least):
        return False
    width = min(len(ux), len(uy))
    if len(ux) != width or len(uy) != width:
        return True
    common = int(_ones(ux & uy))
    most = min(x.slack, y.slack) + common
    return 7 * most >= 3 * (x.least + y.least)


def open_pairs(n, bits, labels, held=None):
    """(rows, rows) arrays, leaf by leaf, of the pairs with different labels that
    the tree over rows sorted by size cannot rule out."""
    held = n if held is None else held
    root = signature_tree(n, bits, labels, held)
    todo = [(root, root)]
    while todo:
        (x, ux), (y, uy) = todo.pop()
        if x is not y and not _may_link(x, ux, y, uy):
            continue
        if x is y and x.label is not None:
            continue
        if x.children is None and y.children is None:
            width = min(x.bits.shape[1], y.bits.shape[1])
            bx, by = _fold(x.bits, width), _fold(y.bits, width)
            nx, ny = n[x.lo : x.hi, None], n[None, y.lo : y.hi]
            common = _ones(bx[:, None, :] & by[None, :, :])
            spare = [held[z.lo : z.hi] - _ones(b) for z, b in ((x, bx), (y, by))]
            most = np.minimum(spare[0][:, None], spare[1][None, :]) + common
            fit = (7 * most >= 3 * (nx + ny)) & (4 * np.minimum(nx, ny) >= 3 * np.maximum(nx, ny))
            fit &= labels[x.lo : x.hi, None] != labels[None, y.lo : y.hi]
            i, j = np.nonzero(np.triu(fit, 1) if x is y else fit)
            if len(i):
                yield x.lo + i, y.lo + j
        elif x is y:
            todo += [(x.children[a], x.children[b]) for a in range(len(x.children)) for b in range(a, len(x.children))]
        elif y.children is None or x.children is not None and x.hi - x.lo >= y.hi - y.lo:
            todo += [(c, (y, uy)) for c in x.children]
        else:
            todo += [((x, ux), c) for c in y.children]


def tree_pairs(cls, n, bits, labels):
    """Pairs of classes with different labels that the tree cannot rule out."""
    order = np.lexsort((cls, n))
    cls = cls[order]
    found = list(open_pairs(n[order], [bits[k] for k in order], labels[order]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = (cls[np.concatenate(side)] for side in zip(*found, strict=True))
    return np.minimum(left, right), np.maximum(left, right)


def spanning_links(cls, sets, labels):
    """Links among the rows that join all labels that any link joins, each pair that
    the group's bitmaps allow compared in full while its labels are apart: fewer links than rows."""
    n = np.array([len(s) for s in sets])
    order = np.lexsort((cls, n))
    cls, n, labels = cls[order], n[order], labels[order].copy()
    sets = [sets[k] for k in order]
    left, right = [], []
    held, bits = shared_bitmaps(sets)
    for rows, others in open_pairs(n, bits, labels.copy(), held):
        apart = labels[rows] != labels[others]
        for i, j in zip(rows[apart].tolist(), others[apart].tolist(), strict=True):
            if labels[i] != labels[j] and _enough(sets[i], sets[j]):
                left.append(min(cls[i], cls[j]))
                right.append(max(cls[i], cls[j]))
                labels[labels == labels[j]] = labels[i]
    return np.array(left, np.int64), np.array(right, np.int64)


def across_pairs(gid, cls, n, bits, labels):
    """For every row the next one of another label, in an order of the group's
    own, unless sizes or bitmaps rule the pair out: no more pairs than rows."""
    order = np.argsort(mix(cls.view(np.uint64) ^ mix(np.array([gid]).view(np.uint64))), kind="stable")
    after, left, right = None, [], []
    for i, j in zip(order[-2::-1].tolist(), order[:0:-1].tolist(), strict=True):
        # The nearest row behind i whose label differs from i's.
        after = j if labels[j] != labels[i] else after
        if after is None or labels[after] == labels[i]:
            continue
        width = min(len(bits[i]), len(bits[after]))
        x, y = _fold(bits[i], width), _fold(bits[after], width)
        most = min(n[i] - _ones(x), n[after] - _ones(y)) + _ones(x & y)
        if 7 * most >= 3 * (n[i] + n[after]):
            left.append(min(cls[i], cls[after]))
            right.append(max(cls[i], cls[after]))
    return np.array(left, np.int64), np.array(right, np.int64)


def _columns(table):
    bits = [np.frombuffer(v.as_buffer(), np.uint64) for chunk in table.column("bits").chunks for v in chunk]
    return table.column("cls").to_numpy(), table.column("n").to_numpy(), bits, table.column("label").to_numpy()


def _across(table):
    """A few candidate pairs of one group's rows (gid, cls, label, n, bits)."""
    a, b = across_pairs(table.column("gid")[0].as_py(), *_columns(table))
    return pa.table({"a": a, "b": b})


def _settle(table):
    """The links of a large group's rows (gid, cls, label, text) that join its labels."""
    press = zstandard.ZstdDecompressor()
    texts = pa.array([press.decompress(v.as_buffer()) for chunk in table.column("text").chunks for v in chunk], pa.binary())
    sets = []
    for _, piece in slices(texts, SLICE_BYTES):
        s = Sets(piece)
        sets += [s.keys[s.ptr[d] : s.ptr[d + 1]].copy() for d in range(len(s.n))]
    a, b = spanning_links(table.column("cls").to_numpy(), sets, table.column("label").to_numpy())
    return pa.table({"a": a, "b": b})


def _search(table):
    """All candidate pairs of one group's rows (gid, cls, label, n, bits)."""
    a, b = tree_pairs(*_columns(table))
    return pa.table({"a": a, "b": b})


def possible(pairs, signs):
    """The (a, b) pairs whose sizes and bitmaps allow a link."""
    left = signs.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    right = signs.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "xa", "xb")
    return joined.transform(mapped, _within_bounds, "a long, b long")


def shared_groups(classes, shingles):
    """(gid, lead, members): distinct lists of classes that share a prefix shingle, from (cls, text) rows."""
    spark = classes.sparkSession
    rows = classes.select("text")
    common = spark.sparkContext.broadcast(_common(classes, shingles))
    parts = partitions_for(spark, shingles // 4)
    buckets = parts * BUCKETS_PER_PARTITION
    posted = rows.transform(mapped, lambda it: _postings(it, buckets, common.value), "bucket int, data binary")
    found = posted.repartition(parts, "bucket").transform(mapped, _groups, "gid long, lead boolean, members binary")
    # The same list comes from many shingles; any lead among them counts.
    return found.groupBy("gid").agg(F.max("lead").alias("lead"), F.first("members").alias("members"))


def searched(groups, signs):
    """(gid, cls, pieces): the members of groups of more than two classes. Large groups with the
    same first member become one where its pairs are no more than theirs together. ``pieces``: how
    many a large group has to be cut into; null for others."""
    size = F.octet_length("members") / 8
    small = groups.where((size > 2) & (size <= LARGE)).select("gid", "members").transform(mapped, _members, "gid long, cls long")
    rows = groups.where((size > 2) & (size > LARGE)).select("gid", "members").transform(mapped, _keyed_members, "gid long, key long, m long, cls long")
    # A group's size once per member: its pairs, twice.
    # What is known of each large group goes to the rows: the rows of a family would meet in one task.
    union = rows.groupBy("key", "cls").agg(F.sum("m").alias("pairs"))
    joint = union.groupBy("key").agg(F.count("*").alias("m"), F.sum("pairs").alias("pairs")).where("m * m <= pairs").select("key")
    large = union.join(F.broadcast(joint), "key", "left_semi").select(F.col("key").alias("gid"), "cls")
    large = large.unionByName(rows.join(F.broadcast(joint), "key", "left_anti").select("gid", "cls"))
    sizes = large.join(signs.select("cls", "n"), "cls").groupBy("gid").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    whole_one = (F.col("m") <= BLOCK) & (F.col("n") <= PIECE_SHINGLES)
    pieces = F.when(whole_one, 1).otherwise(F.greatest(F.ceil(F.col("m") * 2 / BLOCK), F.ceil(F.col("n") * 2 / PIECE_SHINGLES), F.lit(2)))
    large = large.join(F.broadcast(sizes.select("gid", pieces.cast("int").alias("pieces"))), "gid")
    return small.withColumn("pieces", F.lit(None).cast("int")).unionByName(large)


def cut(rows, in_pairs):
    """(gid, ...) rows with groups of several ``pieces`` cut by a hash of the class: into the pieces, or
    ``in_pairs`` into all pairs of them, so that any two members still meet."""
    rows = rows.withColumn("__own", F.pmod(F.xxhash64("cls"), F.coalesce("pieces", F.lit(1))).cast("int"))
    if in_pairs:
        others = F.filter(F.sequence(F.lit(0), F.col("pieces") - 1), lambda o: o != F.col("__own"))
        gids = F.transform(others, lambda o: F.xxhash64("gid", F.least(o, "__own"), F.greatest(o, "__own")))
    else:
        gids = F.array(F.xxhash64("gid", "__own"))
    gids = F.when(F.col("pieces") > 1, gids).otherwise(F.array("gid"))
    return rows.withColumn("gid", F.explode(gids)).drop("__own")


def families(df, text_col="text", id_col="doc_id"):
    """(rows, links). ``rows``: id, text hash ``h``, set size ``n``, class ``cls``
    and ``family``, the same for all rows that links connect. ``links``: (a, b)
    pairs of classes that link; with equal sets they connect all that links connect."""
    kind = df.schema[id_col].dataType.simpleString()
    hashed = df.select(F.col(id_col), F.xxhash64(text_col).alias("h"), F.col(text_col))
    profile = stored(hashed.transform(mapped, _profile, f"id {kind}, h long, n long, cls long, bits binary, text binary"), "sets", "uncompressed")  # texts are compressed already
    shingles = profile.agg(F.sum("n")).first()[0] or 0
    # Once per class and task; the same class from several tasks is as good as one.
    classes = profile.where("text IS NOT NULL").select("cls", "n", "bits", "text")
    groups = stored(shared_groups(classes, shingles), "groups")
    wanted = groups.select("gid", "members").transform(mapped, _members, "gid long, cls long").select("cls").distinct()
    one = F.first(F.struct("n", "bits", "text")).alias("c")
    texts = stored(classes.join(wanted, "cls", "left_semi").groupBy("cls").agg(one).select("cls", "c.*"), "texts", "uncompressed")
    signs = texts.select("cls", "n", "bits")

    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    tried = durable(groups.select("lead", "members").transform(mapped, _first_pairs, "a long, b long").select(*ordered).distinct())
    links = durable(verified(possible(tried, signs), texts))
    labels = components(links)
    members = stored(searched(groups, signs), "members")
    discard(groups)
    # A few pairs across labels first, then every pair that is still open.
    for search in (_across, _search):
        several = members.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("gid", "cls", "pieces", F.coalesce("root", "cls").alias("label"))
        mixed = several.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        several = cut(several.join(mixed.where("lo <> hi").select("gid"), "gid"), search is _search)
        settled = None
        if search is _search:
            # Open pairs of a large group would be many: it is settled whole, and yields links only.
            large = several.where("pieces IS NOT NULL").join(texts.select("cls", "text"), "cls").select("gid", "cls", "label", "text")
            settled = large.groupBy("gid").applyInArrow(_settle, "a long, b long").distinct()
            several = several.where("pieces IS NULL")
        found = several.drop("pieces").join(signs, "cls").groupBy("gid").applyInArrow(search, "a long, b long")
        more = durable(found.distinct().join(tried, ["a", "b"], "left_anti"))
        fresh = verified(more, texts)
        fresh = durable(fresh if settled is None else fresh.unionByName(settled))
        tried, links = tried.unionByName(more), links.unionByName(fresh)
        # What is known of the components stands for all links before.
        labels = components(labels.toDF("a", "b").unionByName(fresh))
    discard(texts, members)

    roots = labels.withColumnRenamed("node", "cls")
    rows = profile.select("id", "h", "n", "cls")
    return rows.join(roots, "cls", "left").withColumn("family", F.coalesce("root", "cls")).drop("root"), links


def jaccard_components(df, text_col="text", id_col="doc_id"):
    """(id, n_shingles, component_id) for every row of ``df``."""
    rows = families(df, text_col, id_col)[0]
    least = rows.where("n > 0").groupBy("family").agg(F.min("id").alias("component_id"))
    linked = rows.where("n > 0").join(least, "family").select("id", "n", "component_id")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(df, text_col="text", id_col="doc_id"):
    """The row with the smallest id of every family, and all rows with an empty
    set; columns unchanged. Of rows equal in id and text one stays."""
    rows = families(df, text_col, id_col)[0]
    first = rows.where("n > 0").groupBy("family").agg(F.min_by(F.struct("id", "h"), F.struct(F.col("id").isNull(), "id", "h")).alias("x"))
    chosen = first.select(F.col("x.id").alias("__id"), F.col("x.h").alias("__h"))
    empty = rows.where("n = 0").select(F.col("id").alias("__id"), F.col("h").alias("__h"))
    zero = F.lit(0).cast(df.schema[id_col].dataType)
    keys = ["__id", "__none", "__h"]
    chosen = chosen.unionByName(empty).select(F.coalesce("__id", zero).alias("__id"), F.col("__id").isNull().alias("__none"), "__h").distinct()
    marked = df.withColumns({"__id": F.coalesce(F.col(id_col), zero), "__none": F.col(id_col).isNull(), "__h": F.xxhash64(text_col)})
    return marked.join(chosen, keys, "left_semi").dropDuplicates(keys).select(*df.columns)


def op_components(documents):
    return jaccard_components(documents).select("doc_id", "n_shingles", "component_id")
