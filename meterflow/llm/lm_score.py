"""Masked pseudo-likelihood from a bidirectional window network.

Every word is predicted from the ``SIDE`` words on either side. The network
sends one embedding per neighbouring place through that place's matrix, adds
them up, applies tanh, and predicts the three digits of the word's id, each
given those before. A text's score is the sum over all its words of the
log-probability given both sides.

Every word with at least sqrt(words of the corpus) / ``RARE`` occurrences has
an id, and so do the ``KNOWN`` most frequent ones; the vocabulary and the grid
of its digits grow with the corpus. All other words share hash buckets. Such a
word has its bucket's probability times its exact share of the bucket's
occurrences, from a join with the counts of all words; per bucket, one
occurrence stands for all words that the corpus does not hold.

Every task trains a copy of the network on its part of all documents. A round
masks one position in as many as there are rounds, the next round the next one,
so that every word is a target exactly once; the copies are averaged, weighted
by trained words, on the cluster, once per round.

Null, empty and blank texts have no words: log-likelihood 0, null per word.
Rows are scored alone, so repeated rows agree; words of equal counts take ids in the order of
their hashes. Very long texts are scored whole, in batches of words. On an empty table the network
keeps its starting weights. Other columns stay; input columns called ``n_words``, ``log_likelihood``
or ``per_word`` are replaced.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..durable import durable
from ..shipping import mapped
from .blobs import runs
from .text import Words, mix, per_text_sum, slices

KNOWN = 1920  # words with an id of their own, however rare
RARE = 200  # the larger, the rarer the words with an id
BUCKETS = 128  # for the other words, at least
VOCABULARY = KNOWN + BUCKETS  # the smallest
SIDE = 3
HIDDEN = 24
ROUNDS = 2  # of training; each takes one position in ROUNDS, together all
BATCH = 1024  # words scored at once, so that their numbers stay in a core's cache
STEP = 512  # masked words of a training step
HELD = 4096  # masked words gathered before steps are made of them
RATE = 0.1
CHUNK = 1024  # parameters per row when copies are averaged
SLICE = 1 << 20
FLUSH = 1 << 20
COPIES_PER_CORE = 4
LOG_ONE = 1 << 32  # logarithms are summed as integers, so that their order does not matter

_PLACES = [k for k in range(-SIDE, SIDE + 1) if k]


def _word_counts(batches):
    """(word hash, count) of the tasks' words, summed in pieces of bounded size."""
    keys, counts = [], []

    def summed():
        k, n = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(k, kind="stable")
        k, n = k[order], n[order]
        first, end = runs(k)
        return k[first], per_text_sum(n, np.append(first, len(n)))

    held = 0
    for batch in batches:
        for _, texts in slices(batch.column(0), SLICE):
            k, n = np.unique(Words(texts).hashes(lower=True), return_counts=True)
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held >= FLUSH:
                k, n = summed()
                keys, counts, held = [k], [n], len(k)
                if held >= FLUSH // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["word", "n"])
                    keys, counts, held = [], [], 0
    if held:
        k, n = summed()
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], names=["word", "n"])


def grid(size):
    """Digits (s / 2, s, s) of the smallest such grid that holds ``size`` ids."""
    s = 2
    while s**3 // 2 < size:
        s += 2
    return s // 2, s, s


class Vocabulary:
    """Word hash to id: frequent words first, by falling count; others by bucket.

    ``rest`` is a table (word, n) of the words without an id that occur more
    than once; tasks get the vocabulary without it.
    """

    def __init__(self, words):
        self.words = np.array(words, np.int64).view(np.uint64)
        self.order = np.argsort(self.words, kind="stable")
        self.sorted = self.words[self.order]
        self.known = max(KNOWN, len(self.words))
        self.size = int(np.prod(grid(self.known + BUCKETS)))
        self.log_bucket = np.zeros(self.size - self.known)
        self.rest = None
        # Where the words with each value of the upper bits start, two to four values to a word.
        bits = len(self.words).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.sorted >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def __getstate__(self):
        return self.__dict__ | {"rest": None}

    def ids(self, hashes):
        other = self.known + (mix(hashes) % np.uint64(self.size - self.known)).astype(np.int64)
        if not len(self.words):
            return other
        upper = (hashes >> self.shift).astype(np.int64)
        at, end = self.starts.take(upper), self.starts.take(upper + 1)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at.take(left)
            found = self.sorted.take(here) == hashes.take(left)
            other[left[found]] = self.order.take(here[found])
            at[left] += 1
            left = left[~found & (here + 1 < end.take(left))]
        return other


def _bucket_counts(batches, words):
    """(bucket, count) of the words without an id."""
    total = np.zeros(words.size - words.known, np.int64)
    for batch in batches:
        np.add.at(total, words.ids(batch.column(0).to_numpy().view(np.uint64)) - words.known, batch.column(1).to_numpy())
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])


def vocabulary(df, text_col="text"):
    """(Vocabulary, log-frequency per id) from the counts of all words of ``df``."""
    spark = df.sparkSession
    counts = durable(df.select(text_col).transform(mapped, _word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = total**0.5 / RARE
    frequent = counts.where(F.col("n") >= least)
    if frequent.count() < KNOWN:
        frequent = counts.orderBy(F.desc("n"), "word").limit(KNOWN)
    top = frequent.toArrow()
    word, n_word = (top.column(k).to_numpy() for k in range(2))
    order = np.lexsort((word, -n_word))
    word, n_word = word[order], n_word[order]
    words = Vocabulary(word)
    n = np.ones(words.size)
    n[: len(word)] += n_word
    if len(word):
        others = counts.where((F.col("n") < int(n_word[-1])) | ((F.col("n") == int(n_word[-1])) & (F.col("word") > int(word[-1]))))
        shared = spark.sparkContext.broadcast(words)
        sums = others.transform(mapped, lambda it: _bucket_counts(it, shared.value), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        n[words.known + sums.column(0).to_numpy()] += sums.column(1).to_numpy()
        words.rest = others.where("n > 1")
    # One occurrence of a bucket is left to words that the corpus does not hold.
    words.log_bucket = np.log(n[words.known :])
    return words, np.log(n / n.sum())


def start_weights(log_frequency, seed=7):
    """Weights that predict by frequency alone, with small random embeddings."""
    rng = np.random.default_rng(seed)
    by_digit = np.exp(log_frequency).reshape(grid(len(log_frequency)))
    a, b, c = by_digit.shape
    first, second = by_digit.sum((1, 2)), by_digit.sum(2)
    weights = {
        "embed": rng.normal(0, 0.1, (len(log_frequency) + 1, HIDDEN)),
        "place": rng.normal(0, HIDDEN**-0.5, (len(_PLACES) * HIDDEN, HIDDEN)),
        "hidden_bias": np.zeros(HIDDEN),
        "to_0": rng.normal(0, 0.05, (HIDDEN, a)),
        "to_1": rng.normal(0, 0.05, (HIDDEN, b)),
        "to_2": rng.normal(0, 0.05, (HIDDEN, c)),
        "bias_0": np.log(first)[None],
        "bias_1": np.log(second / first[:, None]),
        "bias_2": np.log(by_digit / second[:, :, None]).reshape(a * b, c),
    }
    return {k: v.astype(np.float32) for k, v in weights.items()}


def laid_out(ids, ptr, edge, turn=0, rounds=1):
    """(ids in lines of ``rounds``, lines whose first id is a target of this round).

    ``edge`` fills up lines and stands at least SIDE times around every text.
    Over all rounds every word is a target once.
    """
    count = np.diff(ptr)
    before = -(-SIDE // rounds) * rounds
    # The mask moves with the text, so that it does not fall on the same places of all.
    lead = np.where(count > 0, before + (per_text_sum(ids, ptr) - turn) % rounds, 0)
    size = -(-(lead + count) // rounds) * rounds
    at = np.arange(len(ids)) + np.repeat(np.cumsum(size) - size + lead - ptr[:-1], count)
    lines = np.full((int(size.sum()) + before) // rounds * rounds, edge, np.int64)
    lines[at] = ids
    return lines.reshape(-1, rounds), at[at % rounds == 0] // rounds


def _reach(rounds):
    """Lines before and after its own that a target's neighbours lie in."""
    return -(-SIDE // rounds), SIDE // rounds


@functools.cache
def _blocks(rounds):
    """(line, part of its vectors, part of ``place``) of a target's neighbours; lines count from the first in reach."""
    before, after = _reach(rounds)
    out = []
    for line in range(-before, after + 1):
        held = [k for k in range(line * rounds, (line + 1) * rounds) if k in _PLACES]
        if held:
            column, place = held[0] - line * rounds, _PLACES.index(held[0])
            out.append((line + before, slice(column * HIDDEN, (column + len(held)) * HIDDEN), slice(place * HIDDEN, (place + len(held)) * HIDDEN)))
    return out


def _vectors(w, lines):
    return w["embed"].take(lines.ravel(), 0).reshape(len(lines), -1)


def _hidden(w, vectors, rounds):
    """Hidden units of the first word of every line but those that are only reached by others."""
    n = len(vectors) - sum(_reach(rounds))
    x = np.zeros((n, HIDDEN), np.float32)
    for line, part, place in _blocks(rounds):
        x += vectors[line : line + n, part] @ w["place"][place]
    x += w["hidden_bias"]
    return np.tanh(x, out=x)


def _digits(w, ids):
    """(bias row, digit) per level."""
    b, c = w["to_1"].shape[1], w["to_2"].shape[1]
    middle = ids // c
    top = middle // b
    return [(np.zeros_like(ids), top), (top, middle - top * b), (middle, ids - middle * c)]


def _logits(w, hidden, level, row):
    x = hidden @ w[f"to_{level}"]
    x += w[f"bias_{level}"].take(row, 0) if level else w["bias_0"]
    return x


def _exp(w, hidden, level, row, digit):
    """(places of the digits, their logits, exponentials of all logits, sums of these); a row's logits may be shifted."""
    x = _logits(w, hidden, level, row)
    at = np.arange(0, x.size, x.shape[1]) + digit
    own = x.ravel()[at]
    ones = np.ones(x.shape[1], np.float32)
    with np.errstate(over="ignore"):
        total = np.exp(x, out=x) @ ones
    if len(x) and not 1e-30 < total.min() <= total.max() < 1e30:  # too far from 1 for a float
        x = _logits(w, hidden, level, row)
        x -= x.max(1, keepdims=True)
        own = x.ravel()[at]
        total = np.exp(x, out=x) @ ones
    return at, own, x, total


def _log_digits(w, hidden, ids):
    out = np.zeros(len(ids), np.float64)
    for level, (row, digit) in enumerate(_digits(w, ids)):
        _, own, _, total = _exp(w, hidden, level, row, digit)
        out += own - np.log(total)
    return out


def log_probabilities(w, around, ids):
    """Log-probability of every id given its neighbours, by place."""
    out = np.zeros(len(ids), np.float64)
    for a in range(0, len(ids), BATCH):
        near = w["embed"][around[a : a + BATCH]].reshape(-1, len(_PLACES) * HIDDEN)
        out[a : a + BATCH] = _log_digits(w, np.tanh(near @ w["place"] + w["hidden_bias"]), ids[a : a + BATCH])
    return out


def text_log_probabilities(w, ids, ptr):
    """Log-probability of every word of whole texts; a word's vector is fetched once, not once per neighbour."""
    lines, at = laid_out(ids, ptr, len(w["embed"]) - 1)
    out = np.zeros(len(ids), np.float64)
    for a in range(0, len(ids), BATCH):
        here = at[a : a + BATCH]
        hidden = _hidden(w, _vectors(w, lines[here[0] - SIDE : here[-1] + SIDE + 1]), 1)
        out[a : a + BATCH] = _log_digits(w, hidden.take(here - here[0], 0), ids[a : a + BATCH])
    return out


def _adagrad(w, squares, name, g, rate):
    squares[name] += g * g
    w[name] -= rate * g / np.sqrt(squares[name] + 1e-8)


def _adagrad_rows(w, squares, name, key, g, rate):
    """Sum the gradients of equal rows, which lie together, then touch each row once."""
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    first = np.flatnonzero(new)
    # Two floats go as one complex number, which halves the additions.
    g = np.add.reduceat(g.view(np.complex64), first, axis=0).view(np.float32)
    at = key[first]
    new = squares[name].take(at, 0)
    new += g * g
    squares[name][at] = new
    new += np.float32(1e-8)
    np.sqrt(new, out=new)
    g *= np.float32(rate)
    g /= new
    w[name][at] = w[name].take(at, 0) - g


def _step(w, squares, around, ids, rate):
    """One Adagrad step on a batch of masked words; ``around``: lines of ids and the lines that the words begin."""
    lines, at = around
    rounds = lines.shape[1]
    vectors = _vectors(w, lines)
    every = _hidden(w, vectors, rounds)
    # In the order of the ids, the words of a bias row lie together on every level.
    order = np.argsort(ids)
    ids, at = ids[order], at[order] - _reach(rounds)[0]
    hidden, back, share = every.take(at, 0), 0, np.float32(1 / len(ids))
    for level, (row, digit) in enumerate(_digits(w, ids)):
        own, _, p, total = _exp(w, hidden, level, row, digit)
        p *= (share / total)[:, None]
        p.ravel()[own] -= share
        back = back + p @ w[f"to_{level}"].T
        _adagrad(w, squares, f"to_{level}", hidden.T @ p, rate)
        if level:
            _adagrad_rows(w, squares, f"bias_{level}", row, p, rate)
        else:
            _adagrad(w, squares, "bias_0", np.ones((1, len(p)), np.float32) @ p, rate)
    back *= 1 - hidden * hidden
    _adagrad(w, squares, "hidden_bias", np.ones(len(back), np.float32) @ back, rate)
    spread = np.zeros_like(every)
    spread[at] = back
    n, to_vectors, to_place = len(every), np.zeros_like(vectors), np.empty_like(w["place"])
    for line, part, place in _blocks(rounds):
        to_vectors[line : line + n, part] += spread @ w["place"][place].T
        to_place[place] = vectors[line : line + n, part].T @ spread
    _adagrad(w, squares, "place", to_place, rate)
    key = lines.ravel()
    order = np.argsort(key)
    _adagrad_rows(w, squares, "embed", key[order], to_vectors.reshape(-1, HIDDEN).take(order, 0), rate)


def _flat(w):
    return np.concatenate([value.ravel() for value in w.values()])


def _shaped(flat, like):
    out, at = {}, 0
    for name, value in like.items():
        out[name] = flat[at : at + value.size].reshape(value.shape).astype(np.float32)
        at += value.size
    return out


def _train_copy(batches, words, start, turn, rounds, rate):
    """Rows (chunk, words trained on, weights) of a copy trained on one partition."""
    w = {k: v.copy() for k, v in start.items()}
    squares = {k: np.full(v.shape, 1e-4, np.float32) for k, v in w.items()}
    trained, held, size, length = 0, [], 0, 0
    before, after = _reach(rounds)

    def step():
        lines, targets = (np.concatenate(x) for x in zip(*held, strict=True))
        for a in range(0, len(targets), STEP):
            at = targets[a : a + STEP]
            first = at[0] - before
            _step(w, squares, (lines[first : at[-1] + after + 1], at - first), lines[at, 0], rate)
        return len(targets)

    for batch in batches:
        for _, texts in slices(batch.column(0), SLICE):
            t = Words(texts)
            ids = words.ids(t.hashes(lower=True))
            lines, at = laid_out(ids, t.ptr, words.size, turn, rounds)
            held.append((lines, at + length))
            size += len(at)
            length += len(lines)
            if size >= HELD:
                trained += step()
                held, size, length = [], 0, 0
    if size:
        trained += step()
    if trained:
        flat = _flat(w)
        data = [flat[a : a + CHUNK].tobytes() for a in range(0, len(flat), CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(data), dtype=np.int32)), pa.array(np.full(len(data), float(trained))), pa.array(data, pa.binary())],
            names=["chunk", "n", "weights"],
        )


def _average(batches):
    """Weighted mean of every chunk of parameters, one running sum per chunk."""
    total = {}
    for batch in batches:
        for chunk, n, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            own = np.frombuffer(value.as_buffer(), np.float32) * n
            if chunk in total:
                total[chunk][0] += n
                total[chunk][1] += own
            else:
                total[chunk] = [n, own.astype(np.float64)]
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([(v / n).astype(np.float32).tobytes() for n, v in total.values()], pa.binary())],
            names=["chunk", "weights"],
        )


def train(df, text_col="text", rounds=ROUNDS):
    """(Vocabulary, weights) fitted on all texts of ``df``."""
    spark = df.sparkSession
    words, log_frequency = vocabulary(df, text_col)
    weights = start_weights(log_frequency)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # As many copies as keep all cores busy; their weights pass through a shuffle.
    texts = df.select(text_col).coalesce(COPIES_PER_CORE * spark.sparkContext.defaultParallelism)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((words, weights))
        rate = RATE / (1 + turn)
        copies = texts.transform(
            mapped, lambda it, shared=shared, turn=turn, rate=rate: _train_copy(it, *shared.value, turn, rounds, rate), "chunk int, n double, weights binary"
        )
        mean = copies.repartition(parts, "chunk").transform(mapped, _average, "chunk int, weights binary").collect()
        if mean:  # the size of one network
            weights = _shaped(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(mean, key=lambda r: r["chunk"])]), weights)
    return words, weights


def score(df, words, weights, text_col="text"):
    """``df`` without its text but with ``n_words``, ``log_likelihood`` and ``per_word``.

    Input columns of these names are replaced.
    """
    df = df.drop("n_words", "log_likelihood", "per_word")
    fields = [f for f in df.schema if f.name != text_col]
    names = [f.name for f in fields]
    shared = df.sparkSession.sparkContext.broadcast((words, weights))

    def rows(batches):
        words, weights = shared.value
        for batch in batches:
            counts, sums, rest = [np.empty(0, np.int64)], [np.empty(0)], []
            for _, texts in slices(batch.column(batch.schema.get_field_index(text_col)), SLICE):
                t = Words(texts)
                hashes = t.hashes(lower=True)
                ids = words.ids(hashes)
                value = text_log_probabilities(weights, ids, t.ptr)
                other = np.flatnonzero(ids >= words.known)
                value[other] -= words.log_bucket[ids[other] - words.known]
                counts.append(t.count)
                sums.append(per_text_sum(value, t.ptr))
                ends = np.searchsorted(other, t.ptr).astype(np.int32)
                rest.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[other].view(np.int64))))
            n, total = np.concatenate(counts), np.concatenate(sums)
            kept = [batch.column(batch.schema.get_field_index(name)) for name in [*names, "__row"]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n.astype(np.int64)), pa.array(np.where(n > 0, total, 0.0)), pa.concat_arrays(rest) if rest else pa.array([], pa.list_(pa.int64()))],
                names=[*names, "__row", "n_words", "__sum", "__rest"],
            )

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "__row long, n_words long, __sum double, __rest array<long>"])
    out = durable(df.withColumn("__row", F.monotonically_increasing_id()).transform(mapped, rows, kinds))
    total = F.col("__sum")
    if words.rest is not None:
        # What is missing of the words without an id: the logarithms of their counts.
        log_n = F.round(F.log("n") * LOG_ONE).cast("long")
        held = out.select("__row", F.explode("__rest").alias("word")).join(words.rest.select("word", log_n.alias("__log")), "word")
        held = held.groupBy("__row").agg(F.sum("__log").alias("__log"))
        out = out.drop("__rest").join(held, "__row", "left")
        total = total + F.coalesce(F.col("__log"), F.lit(0)) / LOG_ONE
    total = F.when(F.col("n_words") > 0, total).otherwise(F.lit(0.0))
    kept = [F.col(f"`{name}`") for name in names]
    out = out.select(*kept, "n_words", total.alias("log_likelihood"))
    return out.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def op_scores(documents):
    words, weights = train(documents)
    return score(documents.select("doc_id", "text"), words, weights)
