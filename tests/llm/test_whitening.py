"""Contour integration against a dense eigensolver, and the whole query against numpy."""

import numpy as np
import pytest

from meterflow.llm import whitening


def spread(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0), 17_000 + 50 * np.arange(64.0), np.r_[np.ones(20) * 5, 7, 7, 7, 9], np.r_[np.zeros(12), 3, 2], np.r_[1e-9, 1e9, 1e3, 1, 2, 3],
    np.full(6, 4.0), np.array([2.0]), np.r_[1 + 1e-9 * np.arange(10), 4], np.geomspace(1e-3, 1e6, 30), np.zeros(5),
])
def test_components_like_a_dense_solver(values):
    a = spread(values)
    for wanted in (1, 3, 8):
        found, columns = whitening.principal(a, wanted)
        want = np.sort(values)[::-1][:wanted]
        scale = max(np.abs(values).max(), 1e-300)
        assert np.allclose(found, want, atol=1e-12 * scale)
        assert np.abs(columns.T @ columns - np.eye(columns.shape[1])).max() < 1e-8
        assert np.abs(a @ columns - columns * found).max() <= 1e-11 * scale


def test_inertia_counts():
    values = np.array([1.0, 2, 2, 3, 10, 11])
    count = whitening.Inertia(spread(values))
    for shift in (0.5, 1.5, 2.5, 5, 10.5, 12):
        assert count.above(shift) == (values > shift).sum()


def test_missing_one_is_an_error(monkeypatch):
    real = whitening.contour_space
    def lossy(*args, **kw):
        values, columns, residual, size = real(*args, **kw)
        return values[1:], columns[:, 1:], residual[1:], size
    monkeypatch.setattr(whitening, "contour_space", lossy)
    with pytest.raises(ArithmeticError, match="counted"):
        whitening.principal(spread(np.arange(1.0, 9.0)), 3)


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for top in (50, 10**6, 2**51):
        y = rng.integers(-top, top, (30, 4))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(4)] for i in range(4)]
        assert whitening.exact_products(y).tolist() == want
        assert whitening.exact_sum(y) == [sum(map(int, y[:, i])) for i in range(4)]


def plain(rows, k=8):
    """The result by numpy in a loop over Python integers."""
    good = [(i, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    n, d = len(good), len(good[0][1])
    sums = [sum(x[j] for _, x in good) for j in range(d)]
    centred = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for _, x in good])
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    values, columns = values[::-1][:k], columns[:, ::-1][:, :k]
    out = {}
    for (i, x), c in zip(good, centred):
        out.setdefault(i, []).append((sum((n * a - s) ** 2 for a, s in zip(x, sums)), c @ columns / np.sqrt(values)))
    return n, values / np.trace(centred.T @ centred / n), out


def test_whole_query_like_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(np.float32(v)) for v in rng.normal(size=12) * np.arange(1, 13)]) for k in range(200)]
    rows += [(200, None), (201, [None] + [0.5] * 11), (202, [float("nan")] * 12), (203, [float("inf")] + [0.0] * 11), (204, []), (5, rows[7][1]), (6, rows[6][1])]
    df = spark.createDataFrame(rows + [(300, [1.0, 2.0])], "vec_id long, embedding array<float>").selectExpr("*", "1 AS component", "2 AS n").repartition(4)
    got = whitening.op_whiten(df).collect()
    n, explained, want = plain(rows)
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    mine = {}
    for r in got:
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        mine.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    signs = None
    for i, found in want.items():
        for deviation, w in found:
            own = np.array([mine[i, deviation][c][0] for c in range(1, 9)])
            signs = np.sign(own * w) if signs is None else signs
            assert np.allclose(own * signs, w, atol=1e-9)


@pytest.mark.parametrize("rows, n", [([], 0), ([(1, None)], 0), ([(1, [0.5, 0.25])], 1), ([(1, [1.0, 2.0]), (2, [2.0, 1.0]), (None, [2.0, 1.0])], 3), ([(k, [0.5, 0.5]) for k in range(5)], 5)])
def test_few_rows(spark, rows, n):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.op_whiten(df).collect()
    assert len(got) == 2 * n
    if n == 3:
        first = [r for r in got if r["component"] == 1]
        assert all(abs(r["whitened"]) > 0.1 for r in first) and first[0]["explained"] == pytest.approx(1.0)
        assert all(r["whitened"] is None for r in got if r["component"] == 2)
    if n in (1, 5):
        assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in got)


def test_large_entries(spark):
    rows = [(k, [1e9 * k, -3e8 + k]) for k in range(50)] + [(60, [1e30, 0.0])]
    got = whitening.op_whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 100 and {r["n"] for r in got} == {50}
    assert all(r["deviation"] is None or r["deviation"] <= 2**63 - 1 for r in got)
