"""Quality: a regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance
and towards a multiple of the identity. A document's score is the logistic of
the difference of its two log densities, from Mahalanobis distances with
Cholesky factors that are computed once and shipped to the tasks.

Null and empty texts have all statistics at zero words and get an ordinary
score. Rows are scored one by one, so ties and repeated rows agree; labels of
null value are not learned from. Without rows of both classes every score is
the share of class 1 (0.5 without any label). Statistics cover whole texts, however long; an
empty table gives no rows. Only id and text are read for scores; ``keep_good`` leaves all columns,
whatever their names, as they are.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..durable import durable
from ..shipping import mapped
from .text import SLICE_BYTES, Words, mix, per_text_sum, slices, windows

FEATURES = (
    "words word_bytes distinct repeated_runs symbols uppercase digits bars exclaims stops lines longest_share short doubled".split()
)
TO_POOLED = 0.2
TO_IDENTITY = 0.02
# Shares count this many neutral words (or so many characters) besides a text's
# own, so that a handful of words is not taken for a pattern.
NEUTRAL_WORDS = 30
LEAST_VARIANCE = 1e-6
NEUTRAL_CHARS = 150
REJECT_BELOW = 0.3

_CLASS = np.zeros(256, np.uint8)  # bits: 1 symbol, 2 upper, 4 digit, 8 bar, 16 exclamation, 32 stop or comma, 64 newline, 128 letter
for _bit, _chars in ((1, b"#*$%&<>"), (4, b"0123456789"), (8, b"|"), (16, b"!?"), (32, b".,;:"), (64, b"\n")):
    _CLASS[list(_chars)] |= _bit
_CLASS[65:91] |= 2 | 128
_CLASS[97:123] |= 128


def _distinct_share(keys, doc, docs, total):
    """Share of distinct keys per document (1 without keys)."""
    own = np.sort(mix(keys ^ mix(doc.astype(np.uint64) + np.uint64(1))))
    # Mixed with its document a key is unique to it, so duplicates of the whole slice are duplicates of one document.
    repeats = own[1:][own[1:] == own[:-1]]
    if not len(repeats):
        return np.ones(docs)
    values, extra = np.unique(repeats, return_counts=True)
    mixed = mix(keys ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    at = np.minimum(np.searchsorted(values, mixed), len(values) - 1)
    hit = values[at] == mixed
    # Each duplicated key adds (copies - 1) / copies per copy.
    lost = np.bincount(doc[hit], extra[at[hit]] / (extra[at[hit]] + 1.0), docs)
    return 1.0 - lost / (total + NEUTRAL_WORDS)


def features(texts):
    """Matrix of transformed statistics, a row per text of the slice."""
    w = Words(texts)
    docs, n = len(w.count), w.count.astype(float)
    size = np.diff(w.offsets).astype(float) + NEUTRAL_CHARS
    kinds = _CLASS[w.bytes]

    def share(bit, of=size):
        return per_text_sum((kinds & bit > 0).astype(np.int64), w.offsets) / of

    length = w.end - w.start
    doc = w.text_of_word()
    hashes = w.hashes(lower=True)
    distinct = _distinct_share(hashes, doc, docs, n)
    doubled = np.zeros(len(w), bool)
    doubled[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    runs = windows(hashes, 4)
    ok = w.left_in_text()[: len(runs)] >= 4
    repeated = 1.0 - _distinct_share(runs[ok], doc[: len(runs)][ok], docs, np.maximum(n - 3, 0))
    chars = per_text_sum(length, w.ptr).astype(float)
    longest = np.zeros(docs)
    np.maximum.at(longest, doc, length)
    letters = share(128, np.ones(docs)) + NEUTRAL_CHARS
    safe = n + NEUTRAL_WORDS
    mean = (chars + 5 * NEUTRAL_WORDS) / safe
    columns = [
        np.log1p(n),
        np.log(mean),
        distinct,
        np.log(repeated + 0.01),
        np.log(share(1) + 0.003),
        np.log(share(2, letters) + 0.01),
        np.log(share(4) + 0.003),
        np.log(share(8) + 0.003),
        np.log(share(16) + 0.003),
        np.log(share(32) + 0.003),
        np.log(share(64, safe) + 0.003),
        np.log1p(longest) - np.log(mean),
        per_text_sum((length <= 2).astype(np.int64), w.ptr) / safe,
        np.log(per_text_sum(doubled.astype(np.int64), w.ptr) / (n + 4) + 0.02),
    ]
    return np.column_stack(columns)


def _all_features(column):
    parts = [features(piece) for _, piece in slices(column, SLICE_BYTES)]
    return np.concatenate(parts) if parts else np.empty((0, len(FEATURES)))


class Model:
    """Fitted densities of the two classes; ``score`` takes a feature matrix."""

    def __init__(self, moments, to_pooled=TO_POOLED, to_identity=TO_IDENTITY):
        total = sum(m[0] for m in moments.values())
        self.prior = (moments[1][0] / total) if total and 1 in moments else (0.0 if total else 0.5)
        self.parts = None
        if len(moments) < 2 or min(m[0] for m in moments.values()) < 2:
            return
        p = len(FEATURES)
        scatter = {k: s2 - np.outer(s1, s1) / n for k, (n, s1, s2) in moments.items()}
        pooled = sum(scatter.values()) / max(total - 2, 1)
        # Statistics that never vary get a small spread instead of none.
        self.scale = np.sqrt(np.maximum(np.diag(pooled), LEAST_VARIANCE))
        self.parts = {}
        for k, (n, s1, _) in moments.items():
            # Small classes lean on the pooled covariance more.
            own = (1 - to_pooled) * n / (n + p)
            cov = (own * scatter[k] / max(n - 1, 1) + (1 - own) * pooled) / np.outer(self.scale, self.scale)
            cov = (1 - to_identity) * cov + (to_identity * np.trace(cov) / p + 1e-6) * np.eye(p)
            factor = np.linalg.cholesky(cov)
            self.parts[k] = (s1 / n / self.scale, np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), np.log(n / total))

    def score(self, x):
        if self.parts is None:
            return np.full(len(x), float(self.prior))
        log_density = {}
        for k, (mean, whiten, log_det, log_prior) in self.parts.items():
            z = (x / self.scale - mean) @ whiten.T
            log_density[k] = log_prior - 0.5 * ((z * z).sum(1) + log_det)
        gap = np.clip(log_density[1] - log_density[0], -500, 500)
        return 1.0 / (1.0 + np.exp(-gap))


def document_features(df, id_col="doc_id", text_col="text"):
    """``df``'s ids with ``stats``, the transformed statistics of each text."""

    def rows(batches):
        for batch in batches:
            values = _all_features(batch.column(1))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], names=[id_col, "stats"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).transform(mapped, rows, f"`{id_col}` {kind}, stats array<double>")


def fit(stats, labels, label_col="quality", id_col="doc_id", **shrinkage):
    """A Model from all labelled rows; class moments are summed on the cluster."""
    labelled = (
        labels.select(id_col, F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1))
        .join(stats.select(id_col, "stats"), id_col)
    )
    p = len(FEATURES)

    def moments(batches):
        total = {}
        for batch in batches:
            x = np.array(batch.column(1).values.to_numpy(zero_copy_only=False)).reshape(-1, p)
            y = batch.column(0).to_numpy()
            for k in np.unique(y):
                own = x[y == k]
                flat = np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
                total[k] = total.get(k, 0) + flat
        for k, flat in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(flat), k, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["label", "at", "value"]
            )

    rows = (
        labelled.select("label", "stats").transform(mapped, moments, "label int, at int, value double")
        .groupBy("label", "at").agg(F.sum("value").alias("value")).collect()
    )
    flat = {}
    for r in rows:
        flat.setdefault(r["label"], np.zeros(1 + p + p * p))[r["at"]] = r["value"]
    return Model({k: (v[0], v[1 : 1 + p], v[1 + p :].reshape(p, p)) for k, v in flat.items()}, **shrinkage)


def train(documents, labels, id_col="doc_id", text_col="text", label_col="quality"):
    """(stats of all documents, Model fitted on the labelled ones)."""
    stats = durable(document_features(documents, id_col, text_col))
    return stats, fit(stats, labels, label_col, id_col)


def score_stats(stats, model, id_col="doc_id"):
    def rows(batches):
        for batch in batches:
            x = batch.column(1).values.to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=[id_col, "score"])

    kind = stats.schema[id_col].dataType.simpleString()
    return stats.select(id_col, "stats").transform(mapped, rows, f"`{id_col}` {kind}, score double")


def keep_good(df, model, text_col="text", reject_below=REJECT_BELOW):
    """The rows of ``df`` whose texts score at least ``reject_below``, columns unchanged."""

    def rows(batches):
        for batch in batches:
            x = _all_features(batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array(model.score(x) >= reject_below))

    return df.transform(mapped, rows, df.schema)


def learnable(labels, id_col="doc_id", modulus=5, held_out=0):
    """Rows whose crc32(id as text) is not ``held_out`` modulo ``modulus``."""
    return labels.where(F.crc32(F.col(id_col).cast("string")) % modulus != held_out)


def op_scores(documents, labels):
    stats, model = train(documents, learnable(labels))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return score_stats(stats, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted")
    )
