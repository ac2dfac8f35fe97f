"""Toxicity: a subsequence string kernel machine with Nystroem landmarks.

A text is taken as one sequence of letters: case, accents, spaces and all other
signs are dropped, so ``i.d.i.o.t``, ``i d i o t``, ``id iot`` and an insult of
several words are letters in a row like the plain word. The end of a sentence
stands as one foreign letter in between. Letters beyond a-z are spelled with
three codes. Two stretches of letters are compared by the gap-weighted kernel over
common subsequences of ``ORDER`` and ``ORDER - 1`` letters: a subsequence counts
``DECAY`` per letter skipped, so inserted or left out letters cost little.

Training rows are stretches of ``STRETCH`` letters cut from the sentences of
labelled texts, with the label of their text. From a toxic text come those
that hold runs of letters which toxic texts have far too often, from other texts
those that look most alike and some by hash. Unlike such runs serve as landmarks, with some
stretches of clean texts; a support vector machine in their kernel space weighs
them. Its weights fold into one table over subsequences, so every place of a text is scored
by a few look-ups. A text is judged by its worst stretches and their number; a
logistic fitted on labelled texts turns these into a score.

Null texts, empty texts and texts without letters have the least margins and all
the same score. Texts are scored whole and alone, so repeated rows and ties
agree, and very long ones only take time in proportion: the working memory is that of a
block of letters besides some bytes per letter. Where labels repeat or contradict each other, every labelled row counts. Without labels of
both classes the score is the share of toxic labels (0 without any), so empty
tables of labels or texts do no harm. A column of ``df`` that is called ``score`` is replaced; all others stay.
"""

import itertools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..shipping import mapped
from .text import slices

# Bounds of the fit: labelled rows per class (in hash order), stretches per text, runs and landmarks.
TOXIC_DOCS = 4_000
OTHER_DOCS = 8_000
PER_TEXT = 3
RUNS = 4_000
FEWEST_RUNS = 200  # when none is beyond chance
TOXIC_LANDMARKS = 96
OTHER_LANDMARKS = 32

ORDER = 4
SPAN = 8  # letters that a subsequence may stretch over
SHORT_SPAN = 5
SHORT_WEIGHT = 0.5
DECAY = 0.6
STRETCH = 24
BITS = 5
CODES = 1 << BITS
BLOCK = 1 << 15
WORST = 3  # stretches whose margins count one by one
PENALTY = 10.0
SLICE = 1 << 20

_SPACE, _MARK, _SKIP, _SPELLED, _BREAK = 100, 101, 102, 103, 0
_TABLES = {}


def _code_table():
    """Code per code point: 1 to 26 for letters that reduce to a-z, else a kind of sign."""
    if "codes" not in _TABLES:
        def one(i):
            c = chr(i)
            if c in "\n\r。！？  ":
                return _BREAK
            if c in ".!?…":
                return _MARK
            if c.isspace():
                return _SPACE
            if not c.isalpha():
                return _SKIP
            base = unicodedata.normalize("NFKD", c)[0].lower()
            return ord(base) - 96 if "a" <= base <= "z" else _SPELLED
        _TABLES["codes"] = np.fromiter(map(one, range(0x110000)), np.uint8, 0x110000)
    return _TABLES["codes"]


class Letters:
    """The letter codes of some texts in a row: text d holds ``codes[start[d]:end[d]]``."""

    def __init__(self, texts):
        # Texts stand apart by so many breaks that no subsequence reaches over.
        lowered = [t.lower() + "\n" * SPAN for t in texts]
        ends = np.cumsum([0, *map(len, lowered)])
        flat = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
        code = _code_table()[flat]
        closing = np.flatnonzero(code == _MARK)
        closing = closing[closing + 1 < len(code)]
        after = code[closing + 1]
        code[closing[(after == _SPACE) | (after == _BREAK)]] = _BREAK
        kept = np.flatnonzero((code <= 26) | (code == _SPELLED))
        size = np.where(code[kept] == _SPELLED, 3, 1)
        bounds = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(kept, ends)]
        codes = np.repeat(code[kept], size).astype(np.int64)
        spelled = np.flatnonzero(code[kept] == _SPELLED)
        if len(spelled):
            at, point = (np.cumsum(size) - size)[spelled], flat[kept[spelled]].astype(np.int64)
            codes[at], codes[at + 1], codes[at + 2] = 27 + point % 5, 1 + point // 5 % 31, 1 + point // 155 % 31
        self.codes, self.start, self.end = codes, bounds[:-1], np.maximum(bounds[1:] - SPAN, bounds[:-1])


def patterns():
    """(distances of the earlier letters from the last one, falling; weight) of all subsequences."""
    out = []
    for order, span, scale in ((ORDER, SPAN, 1.0), (ORDER - 1, SHORT_SPAN, SHORT_WEIGHT)):
        for back in itertools.combinations(range(span - 1, 0, -1), order - 1):
            out.append((back, scale * DECAY ** (back[0] + 1 - order)))
    return out


def _key(parts):
    """One number per subsequence; those of ``ORDER - 1`` letters lie behind the longer ones."""
    key = parts[0]
    for p in parts[1:]:
        key = key << BITS | p
    return key if len(parts) == ORDER else key + CODES**ORDER


TABLE = CODES**ORDER + CODES ** (ORDER - 1)


def _norms():
    """Length of the weighted occurrence vector of a stretch, by its letters (that of ``ORDER`` letters at least)."""
    out = np.zeros(STRETCH + 1)
    for back, weight in patterns():
        for last in range(back[0], STRETCH):
            out[last + 1 :] += weight * weight
    return np.sqrt(np.maximum(out, out[ORDER]))


def rows_of(stretches):
    """Code rows of letter strings, 0 after their end."""
    m = np.zeros((len(stretches), STRETCH), np.int64)
    for r, s in enumerate(stretches):
        codes = Letters([s]).codes[: len(s)][:STRETCH]
        m[r, : len(codes)] = codes
    return m


def _features(matrix):
    """(rows, keys, weight) of every pattern at every place of code rows; subsequences with a break are left out."""
    for back, weight in patterns():
        for last in range(back[0], matrix.shape[1]):
            parts = [matrix[:, last - b] for b in (*back, 0)]
            on = np.flatnonzero(np.minimum.reduce(parts) > 0)
            if len(on):
                yield on, _key([p[on] for p in parts]), weight


def _sizes(matrix):
    """Letters up to the last one of each row."""
    return np.where(matrix > 0, np.arange(1, matrix.shape[1] + 1), 0).max(axis=1, initial=0)


class Landmarks:
    """Landmark rows, ready to be compared with others."""

    def __init__(self, matrix):
        found = [(on, keys, np.full(len(on), weight)) for on, keys, weight in _features(matrix)]
        rows, keys, weights = (np.concatenate([f[k] for f in found]) if found else np.empty(0, int) for k in range(3))
        weights = weights / _norms()[_sizes(matrix)][rows]
        self.keys, place = np.unique(keys, return_inverse=True)
        self.table = np.zeros((len(self.keys), len(matrix)), np.float32)
        np.add.at(self.table, (place, rows), weights)
        self.number = np.full(TABLE, -1, np.int32)
        self.number[self.keys] = np.arange(len(self.keys))

    def kernel(self, matrix):
        """Kernel values of code rows with the landmarks."""
        out = np.zeros((len(matrix), self.table.shape[1]), np.float32)
        for on, keys, weight in _features(matrix):
            number = self.number[keys]
            hit = np.flatnonzero(number >= 0)
            out[on[hit]] += np.float32(weight) * self.table[number[hit]]
        return out / _norms()[_sizes(matrix)][:, None]

    def folded(self, weights):
        """One weight per subsequence for a weighted sum of the landmarks."""
        out = np.zeros(TABLE, np.float32)
        out[self.keys] = self.table @ weights
        return out


def kernel(matrix, against):
    return Landmarks(against).kernel(matrix)


def diverse(matrix, importance, count):
    """Indices of important rows that are unlike one another."""
    left, chosen = importance.astype(float).copy(), []
    while len(chosen) < min(count, len(matrix)):
        best = int(left.argmax())
        if left[best] <= 0:
            break
        chosen.append(best)
        near = kernel(matrix, matrix[[best]])[:, 0]
        left = np.minimum(left, importance * np.clip(1 - near, 0, 1))
        left[chosen] = 0
    return chosen


def support_vector_machine(z, y, cost, rounds=30):
    """Weights and bias of the squared hinge loss, by Newton steps on the rows inside the margin."""
    x = np.column_stack([z, np.ones(len(z))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        a, c = x[inside], cost[inside]
        new = np.linalg.solve(ridge + 2 * (a * c[:, None]).T @ a, 2 * (a * c[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], w[-1]


def place_scores(codes, table):
    """Sum of the table over all subsequences that end at each place."""
    out = np.zeros(len(codes))
    by_span = patterns()
    for first in range(0, len(codes), BLOCK):
        # A block with the letters before it; the missing ones of the first block are breaks.
        part = codes[max(first - SPAN + 1, 0) : first + BLOCK]
        part = np.concatenate([np.zeros(SPAN - 1 - min(first, SPAN - 1), np.int64), part])
        n = len(part) - SPAN + 1
        back = [part[SPAN - 1 - b : SPAN - 1 - b + n] for b in range(SPAN)]
        pairs = {b: part[:-b] << BITS | part[b:] for b in range(1, SPAN)}  # by the place of the later letter, less b
        total = np.zeros(n)
        for distances, weight in by_span:
            if len(distances) == ORDER - 1:
                a, b, c = distances
                head = pairs[a - b][SPAN - 1 - a : SPAN - 1 - a + n]
                key = head << (2 * BITS) | pairs[c][SPAN - 1 - c : SPAN - 1 - c + n]
                total += weight * table[key]
            else:
                a, b = distances
                key = pairs[a - b][SPAN - 1 - a : SPAN - 1 - a + n] << BITS | back[0]
                total += weight * table[CODES**ORDER + key]
        out[first : first + BLOCK] = total
    return out


class Model:
    """``weights`` per subsequence, ``bias``, and the logistic over a text's evidence."""

    def __init__(self, weights, bias, share):
        self.weights, self.bias, self.share = weights, bias, share
        self.logistic = None

    def margins(self, letters):
        """(margin of the best stretch that ends in each block, first block of each text, blocks per text)."""
        sums = np.concatenate([[0.0], np.cumsum(place_scores(letters.codes, self.weights))])
        lengths = letters.end - letters.start
        blocks = -(-lengths // STRETCH)
        held = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = letters.start[held] + place
        size = np.minimum(place + 1, STRETCH)
        margin = (sums[at + 1] - sums[at + 1 - size]) / _norms()[size] + self.bias
        starts = np.flatnonzero(place % STRETCH == 0)
        best = np.maximum.reduceat(margin, starts) if len(starts) else np.empty(0)
        return best, np.cumsum(blocks) - blocks, blocks

    def evidence(self, texts):
        """Per text: the largest block margins, then the logs of its positive and of all blocks."""
        least = -1.0
        out = np.full((len(texts), WORST + 2), least)
        out[:, WORST:] = 0
        if self.weights is None:
            return out
        best, first, blocks = self.margins(Letters(texts))
        owner = np.flatnonzero(blocks)
        if not len(owner):
            return out
        first, size = first[owner], blocks[owner]
        # Beyond the support vectors' margin a stretch is no stronger evidence.
        best = np.clip(best, least, 1.0)
        out[owner, WORST] = np.log1p(np.add.reduceat((best > 0).astype(np.int64), first))
        out[owner, WORST + 1] = np.log1p(size)
        text = np.repeat(np.arange(len(owner)), size)
        ordered = best[np.lexsort((-best, text))]
        for k in range(WORST):
            has = size > k
            out[owner[has], k] = ordered[first[has] + k]
        return out

    def calibrate(self, evidence, toxic, rounds=60):
        """Fit the logistic by damped Newton steps with a little shrinkage."""
        x = np.column_stack([evidence, np.ones(len(evidence))])
        w, shrink = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
        shrink[-1, -1] = 1e-3
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (toxic - p) - shrink @ w)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        self.logistic = w

    def score(self, texts):
        if self.weights is None or self.logistic is None:
            return np.full(len(texts), float(self.share))
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ self.logistic[:-1] + self.logistic[-1], -60, 60)))


def labelled_sample(documents, labels, label_col="toxic", id_col="doc_id", text_col="text"):
    """(__y, __text): at most TOXIC_DOCS and OTHER_DOCS labelled rows, in order of a hash of id and text.

    Rows with the same id, text and label count once, so repeated ids do not pass the bound.
    """
    rows = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("__y")).where(F.col("__y").isin(0, 1))
    texts = documents.select(id_col, F.col(text_col).alias("__text"), F.xxhash64(text_col).alias("__h"))
    known = texts.drop("__text").join(rows.distinct(), id_col).distinct()
    order = [F.xxhash64(id_col, "__h"), F.col(id_col), F.col("__h")]
    picked = known.where("__y = 1").orderBy(*order).limit(TOXIC_DOCS).unionByName(known.where("__y = 0").orderBy(*order).limit(OTHER_DOCS))
    # Bounded by the two limits.
    joined = texts.join(F.broadcast(picked), [id_col, "__h"])
    return joined.groupBy(id_col, "__h", "__y").agg(F.first("__text").alias("__text")).select("__y", "__text")


def _run_keys(codes):
    """Key of the ``ORDER`` letters in a row that end at each place from the ORDER-th on; -1 across breaks."""
    parts = [codes[k : len(codes) - ORDER + 1 + k] for k in range(ORDER)]
    return np.where(np.minimum.reduce(parts) > 0, _key(parts), -1) if len(codes) >= ORDER else np.empty(0, np.int64)


def _run_counts(batches):
    """In how many texts of either class each run of letters occurs."""
    counts = np.zeros((2, CODES**ORDER), np.int32)
    for batch in batches:
        for first, piece in slices(batch.column(1), SLICE):
            letters = Letters(piece.to_pylist())
            for y, a, b in zip(batch.column(0).slice(first, len(piece)).to_pylist(), letters.start, letters.end, strict=True):
                keys = np.unique(_run_keys(letters.codes[a:b]))
                counts[y, keys[keys >= 0]] += 1
    seen = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[1, seen].astype(np.int64)), pa.array(counts[0, seen].astype(np.int64))], names=["run", "pos", "neg"])


def _stretches(batches, gains):
    """(label, gain, codes) of some stretches per text: the most telling ones, from other texts also some by hash."""
    rows = {"y": [], "gain": [], "codes": []}
    for batch in batches:
        for first, piece in slices(batch.column(1), SLICE):
            letters = Letters(piece.to_pylist())
            for y, a, b in zip(batch.column(0).slice(first, len(piece)).to_pylist(), letters.start, letters.end, strict=True):
                codes = letters.codes[a:b]
                keys = _run_keys(codes)
                if not len(keys):
                    continue
                gain = np.concatenate([np.zeros(ORDER - 1), np.where(keys >= 0, gains[keys], 0)])
                sums = np.concatenate([[0.0], np.cumsum(gain)])
                # Sums of the runs that lie in the stretch from each place on.
                ends = np.minimum(np.arange(len(codes)) + STRETCH, len(codes))
                inside = sums[ends] - sums[np.minimum(np.arange(len(codes)) + ORDER - 1, ends)]
                places = []
                for _ in range(PER_TEXT if y else 1):
                    best = int(inside.argmax())
                    if inside[best] <= 0:
                        break
                    # The telling runs stand in the middle of the stretch.
                    held = np.flatnonzero(gain[best : best + STRETCH])
                    middle = best + (held[0] + held[-1]) // 2
                    places.append((max(0, min(middle - STRETCH // 2, len(codes) - STRETCH)), inside[best]))
                    inside[max(best - STRETCH, 0) : best + STRETCH] = 0
                if not y:
                    hashed = int(codes.sum()) * 2654435761 % (1 << 32)
                    places += [(hashed * (k + 3) // 7 % len(codes), 0.0) for k in range(PER_TEXT - 1)]
                for at, g in places:
                    rows["y"].append(y)
                    rows["gain"].append(float(g))
                    rows["codes"].append(codes[at : at + STRETCH].astype(np.uint8).tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(rows["y"], pa.int32()), pa.array(rows["gain"], pa.float64()), pa.array(rows["codes"], pa.binary())], names=["y", "gain", "codes"])


def _matrix(codes):
    """Code rows from bytes."""
    m = np.zeros((len(codes), STRETCH), np.int64)
    for r, c in enumerate(codes):
        m[r, : len(c)] = np.frombuffer(c, np.uint8)
    return m


def telling_pieces(codes, gains):
    """{codes of the letters that the telling runs cover: their gain} over stretches."""
    found = {}
    for stretch in codes:
        keys = _run_keys(np.frombuffer(stretch, np.uint8).astype(np.int64))
        gain = np.where(keys >= 0, gains[keys], 0)
        on = np.flatnonzero(gain)
        for group in np.split(on, np.flatnonzero(np.diff(on) > ORDER) + 1) if len(on) else ():
            piece = stretch[group[0] : group[-1] + ORDER]
            found[piece] = found.get(piece, 0.0) + float(gain[group].sum())
    return found


def train(documents, labels, label_col="toxic", id_col="doc_id", text_col="text"):
    """A Model from a bounded sample of the labelled texts."""
    sample = labelled_sample(documents, labels, label_col, id_col, text_col).persist()
    try:
        return _train(sample)
    finally:
        sample.unpersist()


def _train(sample):
    spark = sample.sparkSession
    texts = {r["__y"]: r["count"] for r in sample.groupBy("__y").count().collect()}
    pos, neg = texts.get(1, 0), texts.get(0, 0)
    if not pos or not neg:
        return Model(None, 0.0, 1.0 if pos else 0.0)
    base = pos / (pos + neg)
    counts = sample.transform(mapped, _run_counts, "run long, pos long, neg long").groupBy("run").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n = F.col("pos") + F.col("neg")
    share = F.col("pos") / n
    other = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    # How unlikely so many toxic texts are by chance; there are at most CODES ** ORDER runs.
    gain = n * (share * F.log(share / base) + other)
    found = counts.where(F.col("pos") > 0).withColumn("gain", gain).where(share > (1 + base) / 2).orderBy(F.desc("gain"), "run").limit(RUNS).toArrow()
    least = np.log(CODES**ORDER) + 3
    runs, gain = found["run"].to_numpy(), found["gain"].to_numpy()
    sure = gain > least
    use = sure if sure.any() else np.arange(len(gain)) < FEWEST_RUNS
    gains = np.zeros(CODES**ORDER, np.float32)
    gains[runs[use]] = gain[use]
    shared = spark.sparkContext.broadcast(gains)
    rows = sample.transform(mapped, lambda it: _stretches(it, shared.value), "y int, gain double, codes binary").toArrow()  # PER_TEXT per text at most
    # The order of rows decides between equals, so it must not depend on tasks.
    rows = rows.sort_by([("y", "ascending"), ("gain", "descending"), ("codes", "ascending")])
    y, codes = rows["y"].to_numpy(), rows["codes"].to_pylist()
    toxic = [c for c, label in zip(codes, y, strict=True) if label]
    clean = [c for c, label in zip(codes, y, strict=True) if not label]
    if not toxic or not clean:
        return Model(None, 0.0, float(base))
    pieces = sorted(telling_pieces(toxic, gains).items(), key=lambda item: (-item[1], item[0]))[:RUNS]
    model = fit_stretches(toxic, clean, pieces, base)
    model_shared = spark.sparkContext.broadcast(model)

    def evidence(batches):
        for batch in batches:
            for first, piece in slices(batch.column(1), SLICE):
                found = model_shared.value.evidence(piece.to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(piece)), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    seen = sorted(map(tuple, sample.transform(mapped, evidence, "y int, x array<double>").collect()))  # bounded like the sample
    model.calibrate(np.array([x for _, x in seen]), np.array([y for y, _ in seen], float))
    return model


def fit_stretches(toxic, clean, pieces, share):
    """Model of stretch margins from code strings of either class and {piece: importance} for landmarks."""
    pos, neg, parts = _matrix(toxic), _matrix(clean), _matrix([p[:STRETCH] for p, _ in pieces])
    landmarks = np.concatenate([
        parts[diverse(parts, np.sqrt(np.array([g for _, g in pieces])), TOXIC_LANDMARKS)],
        neg[diverse(neg[: 4 * OTHER_LANDMARKS], np.ones(min(len(neg), 4 * OTHER_LANDMARKS)), OTHER_LANDMARKS)],
    ])
    known = Landmarks(landmarks)
    values, vectors = np.linalg.eigh(known.kernel(landmarks).astype(float))
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
    cost = np.where(y > 0, PENALTY, PENALTY * np.sqrt(max(1.0, len(pos) / len(neg))))
    w, bias = support_vector_machine(known.kernel(np.concatenate([pos, neg])) @ root, y, cost)
    return Model(known.folded(root @ w), float(bias), share)


def score(df, model, text_col="text"):
    """``df`` without its text but with ``score`` (an input column of that name is replaced)."""
    df = df.drop("score")
    names = [f.name for f in df.schema if f.name != text_col]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        model = shared.value
        for batch in batches:
            s = [model.score(piece.to_pylist()) for _, piece in slices(batch.column(batch.schema.get_field_index(text_col)), SLICE)]
            kept = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(s) if s else np.empty(0))], names=[*names, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text_col]
    return df.transform(mapped, rows, ", ".join([*fields, "score double"]))


def op_scores(documents, labels):
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(documents, labels.where(remainder != 0))
    return score(documents.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
