"""Threshold joins against a plain loop over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import negatives


def ints(v):
    if not v or any(c is None or not math.isfinite(c) for c in v):
        return None
    return [math.floor(256 * c) for c in v]


def plain(rows, every=5, positives=5, wanted=3):
    usable = [(i, y, ints(v)) for i, v, y in rows if y is not None and ints(v)]
    first = lambda found, k: sorted(found, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[:k]
    out = []
    for a, y, x in usable:
        if a is None or a % every:
            continue
        scored = [(i, sum(p * q for p, q in zip(x, v)), z) for i, z, v in usable if i != a and len(v) == len(x)]
        for p, ps in first([r[:2] for r in scored if r[2] == y], positives):
            fits = [r[:2] for r in scored if r[2] != y and 50 * ps <= 100 * r[1] <= 95 * ps]
            out += [(a, p, k + 1, n, ps, ns) for k, (n, ns) in enumerate(first(fits, wanted))]
    return sorted(out, key=str)


def vectors(seed, n, d=24, labels=4, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d))
    rows = []
    for k in range(n):
        y = int(rng.integers(labels))
        v = spread * centres[(y + int(rng.random() < 0.4)) % labels] + rng.normal(size=d)
        rows.append((k, [float(np.float32(c)) for c in v / np.linalg.norm(v)], y))
    return rows


def run(spark, rows, every=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS key", "2 AS score", "3 AS x").repartition(5)
    return sorted(map(tuple, negatives.op_negatives(df, F.col("vec_id") % every == 0, **options).collect()), key=str)


@pytest.mark.parametrize("seed, n, d", [(1, 400, 24), (2, 150, 3), (3, 300, 64)])
def test_like_all_pairs(spark, seed, n, d):
    rows = vectors(seed, n, d)
    assert run(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = vectors(4, 120, 8)
    rows += [(200, None, 1), (205, [None] + [0.1] * 7, 1), (210, [float("nan")] * 8, 2), (215, rows[0][1], None), (220, [], 1), (225, [0.0] * 8, 1)]
    rows += [(300 + k, rows[7][1], rows[7][2]) for k in range(30)] + [(400 + k, rows[10][1], 3) for k in range(30)]  # ties
    rows += [(5, rows[5][1], rows[5][2]), (6, rows[6][1], rows[6][2]), (None, rows[8][1], rows[8][2])]  # repeated rows, a null id
    rows += [(500 + k, v[:5], y) for k, v, y in vectors(5, 40, 8)]  # shorter vectors meet one another only
    rows += [(600, rows[0][1], 77)]  # the only one of its label
    assert run(spark, rows) == plain(rows)
    for few in ([], [(1, [0.5], 0)], [(5, [0.5], 0)], [(5, [0.5], 0), (6, [0.5], 0)]):
        assert run(spark, few) == plain(few) == []


def test_blocks_of_anchors_and_rows(spark, monkeypatch):
    rows = vectors(6, 500, 16)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 3000)
    assert run(spark, rows) == plain(rows)


def test_large_entries(spark):
    rows = [(k, [c * 1e7 for c in v], y) for k, v, y in vectors(7, 80, 6)]
    assert run(spark, rows) == plain(rows)


def test_index_finds_every_pair_and_leaves_dimensions_out():
    rng = np.random.default_rng(8)
    rows = np.floor(256 * rng.normal(size=(700, 64)) / 8)
    block = negatives.Anchors(rows[:90], None, None, np.full((90, 1), 30_000.0), np.full((90, 1), np.inf))
    index = negatives.Index(rows[:, block.order], 30_000.0, block.norms[:, -1].max())
    a, r, score = index.pairs(block.entries, block.norms, block.thresholds)
    full = rows[:90] @ rows.T
    assert sorted(zip(a, r, score)) == sorted((i, j, full[i, j]) for i, j in zip(*np.nonzero(full >= 30_000)))
    assert index.listed[0] < len(rows)  # the weakest dimension's list is shorter than the block


def test_best_trims_without_loss(monkeypatch):
    monkeypatch.setattr(negatives, "KEPT", 50)
    import pyarrow as pa

    rng, best, every = random.Random(9), negatives.Best(3, pa.int64()), []
    for _ in range(40):
        batch = [(rng.randrange(4), rng.randrange(6), rng.choice([None, *range(30)])) for _ in range(20)]
        every += batch
        best.add([b[0] for b in batch], [b[1] for b in batch], pa.array([b[2] for b in batch], pa.int64()))
    got = best.trim().to_pylist()
    key = lambda r: (r[0], -r[1], r[2] is None, r[2] or 0)
    want = [r for g in range(4) for r in sorted((e for e in every if e[0] == g), key=key)[:3]]
    assert [(r["g"], r["score"], r["id"]) for r in got] == want
