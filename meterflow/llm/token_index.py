"""Token ids of a corpus in wavelet matrices: one compressed file per shard.

Texts are encoded with a public tokenizer, an end id closes every document, and
documents follow each other by ascending id (null ids last; rows that share an
id by a hash of their text, equal rows in input order). Contiguous pieces of
that sequence are shards. A shard's file holds the ids as a wavelet matrix: one
bit plane per bit of the vocabulary, where the next plane lists first the ids
with a 0 here, then those with a 1. With a count of ones per ``BLOCK`` bits this
answers, from the file alone: the id at a position, how often an id occurs
before a position, and where its k-th occurrence is.

A file is Parquet with a single row, so every file system that Spark reaches
will do: ``part`` and ``seq`` (the order of shards), ``before`` (ids of the part
before the shard), ``n_tokens``, the planes, their block counts and numbers of
zeros, the document ids and where each starts in the shard.

Null and empty texts hold the end id alone. A text is encoded whole; it is handed
to the library in pieces cut where the tokenizer itself always cuts, so that long
texts and repeated words cost little. A shard is closed after the document that
fills it, so a long document makes one larger shard, held whole in one task.
Repeated rows are stored once per row, ties in the id are ordered as above, an
empty table gives no shard and no rows. Only the id and the text are read, so
further columns of any name do no harm.
"""

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..durable import work_dir
from ..shipping import mapped
from .text import slices

SHARD_TOKENS = 1 << 21
END_ID = 2
BLOCK = 512
_WORDS = BLOCK // 64
# Words whose ids a task remembers, and bytes of text that it works on at a time.
CACHE_WORDS = 250_000
SLICE = 1 << 22
# Words that the library gets at a time: its working memory is some hundred times their text.
BULK = 20_000
# Positions that a shard is asked for at a time.
CELL = 1 << 18
SHARD = "part int, seq int, before long, n_tokens long, planes array<binary>, ranks array<binary>, zeros array<long>, doc_id array<{kind}>, doc_start array<long>"


class WaveletMatrix:
    """Ids with rank and select: ``planes`` are little-endian 64-bit words, highest bit first."""

    def __init__(self, n, planes, ranks, zeros):
        self.n, self.planes, self.ranks, self.zeros = n, planes, ranks, zeros

    @classmethod
    def build(cls, ids, depth):
        """The matrix of an array of ids below ``2 ** depth``."""
        ids = np.asarray(ids).astype(np.uint16 if depth <= 16 else np.uint32)
        n, blocks = len(ids), len(ids) // BLOCK + 1
        planes, ranks, zeros = [], [], []
        for bit in range(depth - 1, -1, -1):
            on = ids & ids.dtype.type(1 << bit) != 0
            packed = np.zeros(blocks * BLOCK // 8, np.uint8)
            bits = np.packbits(on, bitorder="little")
            packed[: len(bits)] = bits
            words = packed.view("<u8")
            ones = np.bitwise_count(words).reshape(blocks, _WORDS).sum(1, dtype=np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u4"))
            planes.append(words)
            ids = np.concatenate([ids[~on], ids[on]])
            zeros.append(n - int(ranks[-1][-1]))
        return cls(n, planes, ranks, zeros)

    def _bit(self, plane, at):
        return (self.planes[plane][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def _rank1(self, plane, at):
        """Ones before each position."""
        block, inside = at // BLOCK, at % BLOCK
        total = self.ranks[plane][block].astype(np.int64)
        words = self.planes[plane]
        for w in range(_WORDS):
            width = np.clip(inside - 64 * w, 0, 64)
            low = np.where(width == 64, ~np.uint64(0), (np.uint64(1) << (width % 64).astype(np.uint64)) - np.uint64(1))
            total += np.bitwise_count(words[np.minimum(block * _WORDS + w, len(words) - 1)] & low)
        return total

    def _select(self, plane, k, ones):
        """Position of the k-th (from 0) one or zero."""
        counts = self.ranks[plane].astype(np.int64)
        if not ones:
            counts = np.arange(len(counts)) * BLOCK - counts
        out = np.empty(len(k), np.int64)
        words = self.planes[plane].reshape(-1, _WORDS)
        for part in range(0, len(k), 4096):
            wanted = k[part : part + 4096]
            block = np.searchsorted(counts, wanted, "right") - 1
            bits = np.unpackbits(words[block].view(np.uint8), axis=1, bitorder="little")
            seen = np.cumsum(bits if ones else 1 - bits, axis=1, dtype=np.int64)
            out[part : part + 4096] = block * BLOCK + (seen <= (wanted - counts[block])[:, None]).sum(1)
        return out

    def access(self, at):
        """The ids at an array of positions."""
        at = np.asarray(at, np.int64)
        ids = np.zeros(len(at), np.uint32)
        for plane in range(len(self.planes)):
            on, before = self._bit(plane, at), self._rank1(plane, at)
            ids = (ids << np.uint32(1)) | on
            at = np.where(on, self.zeros[plane] + before, at - before)
        return ids

    def _range(self, token, end):
        """Where the occurrences of ``token`` among the first ``end`` ids lie below the last plane."""
        ends = np.array([0, end], np.int64)
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for plane in range(len(self.planes)):
            before = self._rank1(plane, ends)
            on = token >> (len(self.planes) - 1 - plane) & 1
            ends = self.zeros[plane] + before if on else ends - before
        return int(ends[0]), int(ends[1])

    def rank(self, token, end):
        """How often ``token`` occurs among the first ``end`` ids."""
        first, last = self._range(token, end)
        return last - first

    def count(self, token):
        return self.rank(token, self.n)

    def select(self, token, k):
        """Positions of the occurrences numbered by the array ``k`` (from 0)."""
        first, last = self._range(token, self.n)
        k = np.asarray(k, np.int64)
        if len(k) and (k.min() < 0 or k.max() >= last - first):
            raise IndexError(f"id {token} occurs {last - first} times")
        at = first + k
        for plane in range(len(self.planes) - 1, -1, -1):
            on = token >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, at - self.zeros[plane] if on else at, bool(on))
        return at

    def decode(self):
        """All ids, rebuilt from the last plane upwards."""
        ids = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for plane in range(len(self.planes) - 1, -1, -1):
            on = np.unpackbits(self.planes[plane].view(np.uint8), count=self.n, bitorder="little").astype(bool)
            above = np.empty_like(ids)
            above[~on] = ids[: self.zeros[plane]]
            above[on] = ids[self.zeros[plane] :] | ids.dtype.type(1 << (len(self.planes) - 1 - plane))
            ids = above
        return ids

    @classmethod
    def of_row(cls, row):
        """The matrix in a row of a shard file."""
        return cls(
            row["n_tokens"], [np.frombuffer(p, "<u8") for p in row["planes"]],
            [np.frombuffer(r, "<u4") for r in row["ranks"]], row["zeros"],
        )


def cut_by_spaces(path):
    """Whether the tokenizer always cuts before a space between two non-spaces.

    True of byte-level tokenizers that cut by their usual pattern and change no text first.
    """
    with open(path, encoding="utf-8") as f:
        settings = json.load(f)
    cutter = settings.get("pre_tokenizer") or {}
    added = settings.get("added_tokens") or []
    return (
        settings.get("normalizer") is None and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
    )


_EDGE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"


def _solid(words):
    """Which words of a string array are not empty and have no white space at either end."""
    edged = pc.match_substring_regex(words, f"^$|^{_EDGE}|{_EDGE}$")
    return ~edged.to_numpy(zero_copy_only=False)


def pieces(text):
    """``text`` cut before every space that stands between two non-spaces."""
    out = []
    last_solid = False
    for k, word in enumerate(text.split(" ")):
        part = f" {word}" if k else word
        if last_solid and word and not word[0].isspace():
            out.append([part])
        elif out:
            out[-1].append(part)
        else:
            out = [[part]]
        last_solid = bool(word) and not word[-1].isspace()
    return ["".join(p) for p in out]


class WordTable:
    """Ids of solid words, each with one character before it: the ids follow each other in ``pool``.

    The first ``CACHE_WORDS`` words stay; further ones are encoded anew for every slice.
    """

    def __init__(self, encode, before, cut):
        self.encode, self.before, self.cut = encode, before, cut
        self.known, self.starts, self.sizes, self.pool = {}, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def find(self, words):
        """(start, size, pool) of an array of distinct words; size -1 for those that are not solid."""
        solid, words = _solid(words), words.to_pylist()
        row = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        start, size, pool = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64), self.pool
        start[row >= 0], size[row >= 0] = self.starts[row[row >= 0]], self.sizes[row[row >= 0]]
        new = np.flatnonzero((row < 0) & solid).tolist()
        if new:
            parts, total = [pool], len(pool)
            for a in range(0, len(new), BULK):
                some = new[a : a + BULK]
                # One text for all: the tokenizer cuts at each of the characters in between.
                ids = self.encode("".join([self.before + words[k] for k in some]))
                starts, ends = self.cut(ids)
                start[some], size[some] = starts + total, ends - starts
                parts.append(ids)
                total += len(ids)
            pool = np.concatenate(parts)
            room = CACHE_WORDS - len(self.known)
            if room >= len(new):
                self.known.update(zip((words[k] for k in new), range(len(self.starts), len(self.starts) + len(new)), strict=True))
                self.starts, self.sizes = np.concatenate([self.starts, start[new]]), np.concatenate([self.sizes, size[new]])
                self.pool = pool
        return start, size, pool


class Encoder:
    """Token ids of texts by the tokenizers library.

    Where the tokenizer cuts at spaces, the distinct words of a slice go to the
    library in bulk: words within a line with the space before them, words that
    start a line with a line feed before them, which between two non-spaces is a token of its own.
    Texts with other white space take the plain way, piece by piece.
    """

    def __init__(self, path, by_word):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        feed = self._encode("\n")
        self.by_word = by_word and len(feed) == 1
        if self.by_word:
            after_space = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(self.tokenizer.get_vocab_size())])

            def at_spaces(ids):
                cuts = np.flatnonzero(after_space[ids])
                return cuts, np.append(cuts[1:], len(ids))

            def at_feeds(ids):
                cuts = np.flatnonzero(ids == feed[0])
                return cuts, np.append(cuts[1:], len(ids))

            self.inner, self.first = WordTable(self._encode, " ", at_spaces), WordTable(self._encode, "\n", at_feeds)

    def _encode(self, text):
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _plain(self, text):
        if not self.by_word:
            return self._encode(text)
        cut, found = pieces(text), [np.empty(0, np.uint32)]
        for a in range(0, len(cut), BULK):
            coded = self.tokenizer.encode_batch_fast(cut[a : a + BULK], add_special_tokens=False)
            found.append(np.array([i for e in coded for i in e.ids], np.uint32))
        return np.concatenate(found)

    def encode(self, texts):
        """(ids, number of ids per text) of a string array without nulls."""
        if not self.by_word:
            found = [self._plain(t) for t in texts.to_pylist()]
            return np.concatenate([np.empty(0, np.uint32), *found]), np.array([len(f) for f in found], np.int64)
        lines = pc.split_pattern(texts, "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        # Numbers of the lines of texts and of the words of lines; every text has a line, every line a word.
        line_of = np.repeat(np.arange(len(texts)), lines.value_lengths().to_numpy())
        word_counts = words.value_lengths().to_numpy()
        leads = np.cumsum(word_counts) - word_counts
        coded = pc.dictionary_encode(words.flatten())
        word = coded.indices.to_numpy().astype(np.int64)
        text_of = np.repeat(line_of, word_counts)
        lead = np.zeros(len(word), bool)
        lead[leads] = True
        start, size = np.empty(len(word), np.int64), np.empty(len(word), np.int64)
        pools = []
        for table, on in ((self.inner, ~lead), (self.first, lead)):
            marked = np.zeros(len(coded.dictionary), bool)
            marked[word[on]] = True
            used = np.flatnonzero(marked)
            s, n, pool = table.find(coded.dictionary.take(pa.array(used)))
            back = (np.cumsum(marked) - 1)[word[on]]
            start[on], size[on] = s[back] + sum(map(len, pools)), n[back]
            pools.append(pool)
        # The first word of a text has no line feed before it.
        opening = leads[np.concatenate([[True], line_of[1:] != line_of[:-1]])] if len(line_of) else leads
        solid = size[opening] > 0
        start[opening[solid]] += 1
        size[opening[solid]] -= 1
        plain = np.zeros(len(texts), bool)
        plain[text_of[size < 0]] = True
        size[plain[text_of]] = 0
        counts = np.bincount(text_of, size, len(texts)).astype(np.int64)
        pool = np.concatenate(pools)
        ids = pool[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        if plain.any():
            cuts, parts, done = np.cumsum(counts), [], 0
            for k in np.flatnonzero(plain).tolist():
                own = self._plain(texts[k].as_py())
                parts += (ids[done : cuts[k]], own)
                done, counts[k] = cuts[k], len(own)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, counts


_ENCODERS = {}


def _shards(batches, path, by_word, depth, end_id, shard_tokens):
    """Shard rows from the sorted documents of one partition."""
    # A worker keeps the tokenizer and its words for its next tasks.
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, by_word)
    encoder, part = _ENCODERS[path], TaskContext.get().partitionId()
    seq = before = held = 0
    ids, doc_ids, starts = [], [], []

    def shard():
        m = WaveletMatrix.build(np.concatenate(ids), depth)
        columns = {
            "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "before": pa.array([before]), "n_tokens": pa.array([m.n]),
            "planes": pa.array([[p.tobytes() for p in m.planes]], pa.list_(pa.binary())),
            "ranks": pa.array([[r.tobytes() for r in m.ranks]], pa.list_(pa.binary())), "zeros": pa.array([m.zeros], pa.list_(pa.int64())),
            "doc_id": pa.ListArray.from_arrays(pa.array([0, sum(map(len, doc_ids))], pa.int32()), pa.concat_arrays(doc_ids)),
            "doc_start": pa.array([np.concatenate(starts)], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    for batch in batches:
        for first, texts in slices(batch.column(1), SLICE):
            coded, counts = encoder.encode(texts)
            closes = np.cumsum(counts)
            coded = np.insert(coded, closes, end_id)
            ends = closes + np.arange(1, len(counts) + 1)
            at = taken = 0
            while at < len(counts):
                # Documents up to the one that fills the shard.
                last = min(int(np.searchsorted(ends, taken + shard_tokens - held)), len(counts) - 1)
                ids.append(coded[taken : ends[last]])
                doc_ids.append(batch.column(0).slice(first + at, last + 1 - at))
                starts.append(held + np.concatenate([[taken], ends[at:last]]) - taken)
                held += int(ends[last]) - taken
                at, taken = last + 1, int(ends[last])
                if held >= shard_tokens:
                    yield shard()
                    seq, before, held = seq + 1, before + held, 0
                    ids, doc_ids, starts = [], [], []
    if held:
        yield shard()


def write_shards(documents, path, tokenizer, id_col="doc_id", text_col="text", end_id=END_ID, shard_tokens=SHARD_TOKENS):
    """Encode all documents and write one file per shard to ``path``.

    ``tokenizer`` is a file of the tokenizers library that every executor has.
    The shuffle ranges over id, text hash and row, so neither one id nor one
    repeated row fills a partition; texts are encoded after it, once.
    """
    from tokenizers import Tokenizer

    depth = max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id).bit_length()
    kind = documents.schema[id_col].dataType.simpleString()
    order = [F.col("__id").asc_nulls_last(), F.col("__hash"), F.col("__row")]
    rows = documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).withColumns(
        {"__hash": F.xxhash64("__text"), "__row": F.monotonically_increasing_id()}
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("__id", "__text")
    by_word = cut_by_spaces(tokenizer)
    shards = ordered.transform(mapped, lambda it: _shards(it, tokenizer, by_word, depth, end_id, shard_tokens), SHARD.format(kind=kind))
    shards.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def read_shards(spark, path):
    """The shard rows with ``start``: the ids of all shards before each one."""
    shards = spark.read.parquet(path)
    # One row per part, that is per task of the writing stage.
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sums.select("part", earlier.cast("long").alias("base"))
    return shards.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("before")).drop("base", "before")


def _from_shards(shards, fn, schema, columns=()):
    """``fn(row)`` per shard, a dict of columns, as one DataFrame."""

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield fn(batch.slice(k, 1).to_pylist()[0])

    needed = ["start", "n_tokens", "planes", "ranks", "zeros", *columns]
    return shards.select(*needed).transform(mapped, rows, schema)


def _per_document(spark, path, name, kind, value):
    """(doc_id, start, n_tokens, ``value`` of the ids as little-endian 32-bit numbers) of every document, from the files."""
    shards = read_shards(spark, path)
    id_kind = shards.schema["doc_id"].dataType.elementType.simpleString()

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {field: batch.column(field)[k].as_py() for field in ("start", "n_tokens", "planes", "ranks", "zeros")}
                listed = batch.column("doc_id")[k].values
                starts = batch.column("doc_start")[k].values.to_numpy()
                ids = WaveletMatrix.of_row(row).decode().astype("<u4")
                ends = np.append(starts[1:], row["n_tokens"])
                for a in range(0, len(starts), 4096):
                    s, e = starts[a : a + 4096], ends[a : a + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [listed.slice(a, len(s)), pa.array(s + row["start"]), pa.array(e - s), pa.array([value(ids[i:j]) for i, j in zip(s, e, strict=True)])],
                        names=["doc_id", "start", "n_tokens", name],
                    )

    needed = ["start", "n_tokens", "planes", "ranks", "zeros", "doc_id", "doc_start"]
    return shards.select(*needed).transform(mapped, rows, f"doc_id {id_kind}, start long, n_tokens long, {name} {kind}")


def documents_in(spark, path):
    """(doc_id, start, n_tokens, tokens as little-endian 32-bit numbers) of every document, from the files."""
    return _per_document(spark, path, "tokens", "binary", lambda ids: ids.tobytes())


def tokens_at(spark, path, positions):
    """(position, token) for the distinct ``position``s of a DataFrame; those outside the corpus are left out.

    Positions meet their shard through cells of ``CELL`` positions; a shard is asked
    for the positions of one cell at a time.
    """
    shards = read_shards(spark, path)
    cell = lambda at: F.floor(at / CELL).cast("long")
    cells = F.explode(F.sequence(cell(F.col("start")), cell(F.col("start") + F.col("n_tokens") - 1)))
    spans = shards.select("start", "n_tokens", cells.alias("cell"))
    asked = (
        positions.select(F.col("position").cast("long")).distinct().withColumn("cell", cell(F.col("position")))
        .join(spans, "cell").where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens")))
        .groupBy("start", "cell").agg(F.collect_list("position").alias("asked"))
    )

    def look(row):
        at = np.array(row["asked"], np.int64)
        found = WaveletMatrix.of_row(row).access(at - row["start"])
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(found.astype(np.int64))], names=["position", "token"])

    return _from_shards(shards.join(asked, "start"), look, "position long, token long", ["asked"])


def token_counts(spark, path, tokens):
    """(token, n) over the whole corpus for a list of ids, by two rank look-ups per plane and shard."""
    tokens = [int(t) for t in tokens]

    def look(row):
        m = WaveletMatrix.of_row(row)
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([m.count(t) for t in tokens], pa.int64())], names=["token", "n"])

    return _from_shards(read_shards(spark, path), look, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark, path, token):
    """The positions of every occurrence of an id, by select."""
    token = int(token)

    def look(row):
        m = WaveletMatrix.of_row(row)
        return pa.RecordBatch.from_arrays([pa.array(m.select(token, np.arange(m.count(token))) + row["start"])], names=["position"])

    return _from_shards(read_shards(spark, path), look, "position long")


def op_index(documents, tokenizer, path=None, **options):
    """Write the shards (to the shared folder unless told where), read them back: a digest per document."""
    spark = documents.sparkSession
    path = path or work_dir(spark, "tokens")
    write_shards(documents, path, tokenizer, **options)
    return _per_document(spark, path, "ids_crc32", "long", zlib.crc32)
