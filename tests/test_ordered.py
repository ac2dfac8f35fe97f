"""Operators over range slices: sums, ranks and neighbours that cross slices."""

import datetime as dt
import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from meterflow.functions.normal import normal_cdf, normal_quantile
from meterflow.operators import load, nearest, ordered, regression, series, stats


@pytest.fixture(scope="module")
def hot(spark):
    """A group with nine in ten rows, a null group and a small one."""
    rng = random.Random(1)
    rows = [("big" if k % 10 else rng.choice([None, "small"]), k, rng.choice([None, *range(50)])) for k in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, k int, v long").repartition(6)


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


def test_running_sums_and_ranks(hot):
    rows, df = hot
    want = {}
    for g, members in grouped(rows).items():
        total = 0
        for place, (_, k, v) in enumerate(members, 1):
            total += v or 0
            want[g, k] = total, place
    got = ordered.running_sums(df, ["g"], ["k"], {"total": "v"}).collect()
    assert {(r.g, r.k): r.total for r in got} == {key: t for key, (t, _) in want.items()} and len(got) == len(rows)
    assert {(r.g, r.k): r["rank"] for r in ordered.ranked(df, ["g"], ["k"]).collect()} == {key: p for key, (_, p) in want.items()}
    assert sorted(r["rank"] for r in ordered.ranked(df, [], ["k"]).collect()) == list(range(1, 3001))


def test_carried_last(hot):
    rows, df = hot
    want = {}
    for g, members in grouped(rows).items():
        last = None
        for _, k, v in members:
            last = v if v is not None else last
            want[g, k] = last
    got = ordered.carried_last(df, ["g"], ["k"], ["v"]).collect()
    assert {(r.g, r.k): r.last_v for r in got} == want


def test_a_hot_group_spans_slices(hot):
    _, df = hot
    slices = ordered._sliced(df, ["g"], ["k"]).where("g = 'big'").groupBy("__slice").count().collect()
    assert len(slices) >= 6 and max(r["count"] for r in slices) < 1200


def test_peak_load(spark):
    t = lambda m: dt.datetime(2024, 3, 31, 0, 30) + dt.timedelta(minutes=m)
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), t(s := rng.randrange(300)), t(s + rng.randrange(1, 40)), rng.randrange(1, 9)) for _ in range(400)]
    rows += [("c", t(0), t(0), 5), ("c", t(9), t(3), 5), ("d", None, t(1), 1), ("d", t(1), t(2), None), ("e", t(3), None, 4), ("e", t(5), t(6), 2), ("e", t(8), t(9), 2)]
    df = spark.createDataFrame(rows, "g string, s timestamp_ntz, e timestamp_ntz, v int")
    got = {r.g: (r.peak, r.peak_at, r.active) for r in load.peak_load(df, ["g"], "s", "e", "v").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g and r[1] and r[3] and (r[2] is None or r[2] > r[1])]
        moments = sorted({r[1] for r in mine})
        loads = [(sum(r[3] for r in mine if r[1] <= m and (r[2] is None or m < r[2])), m, sum(1 for r in mine if r[1] <= m and (r[2] is None or m < r[2]))) for m in moments]
        if loads:
            want[g] = max(loads, key=lambda x: (x[0], -(x[1] - t(0)).total_seconds()))
    assert got == want and got["e"] == (6, t(5), 2)


@pytest.mark.parametrize("k, block", [(1, 2), (3, 6), (5, 4096)])
def test_closest_k(spark, k, block):
    rng = random.Random(3)
    rows = [(rng.choice(["w", "w", "w", None, "x"]), f"h{n:03d}", rng.choice([None, 7, 7, rng.randrange(200)])) for n in range(250)] + [("lone", "h999", 1)]
    got = {}
    for r in nearest.closest_k(spark.createDataFrame(rows, "g string, h string, v int"), ["g"], "h", "v", k, block).collect():
        got.setdefault((r.g, r.h), []).append((r.place, r.near_h, r.gap))
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted((v, h) for gg, h, v in rows if gg == g and v is not None)
        for a, (v, h) in enumerate(mine):
            near = sorted((abs(w - v), abs(a - b), b, o) for b, (w, o) in enumerate(mine) if b != a)[:k]
            if near:
                want[g, h] = [(p, o, gap) for p, (gap, _, _, o) in enumerate(near, 1)]
    assert {key: sorted(v) for key, v in got.items()} == want


def test_normal_functions(spark):
    z = [-40.0, -9.0, -7.1, -7.0, -1.5, -1e-9, 0.0, 0.3, 2.0, 6.9, 7.2, 20.0]
    p = [1e-300, 1e-20, 1e-6, 0.01, 0.07, 0.075, 0.3, 0.5, 0.9, 0.93, 0.999, 1 - 1e-12]
    rows = spark.createDataFrame(list(zip(z, p)), "z double, p double").select("z", "p", normal_cdf(F.col("z")).alias("c"), normal_quantile(F.col("p")).alias("q"))
    for r in rows.collect():
        assert r.c == pytest.approx(NormalDist().cdf(r.z), abs=1e-13)
        assert r.q == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-15)


def test_order_statistics(spark):
    rng = random.Random(4)
    values = [rng.gauss(5, 2) for _ in range(400)] + [5.0] * 150
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", 1.0), ("c", None), ("d", float("nan")), ("e", 2.0)], "g string, x double").repartition(5)
    got = {r.g: r for r in stats.normality_by_order(df, "x", ["g"]).collect()}
    values.sort()
    n, mu = len(values), sum(values) / len(values)
    sd = math.sqrt(sum((v - mu) ** 2 for v in values) / (n - 1))
    below = [NormalDist(mu, sd).cdf(v) for v in values]
    ks = max(max((i + 1) / n - b, b - i / n) for i, b in enumerate(below))
    q = [NormalDist().inv_cdf((i + 1 - 0.375) / (n + 0.25)) for i in range(n)]
    w = sum(a * b for a, b in zip(values, q)) ** 2 / (sum((v - mu) ** 2 for v in values) * sum(b * b for b in q))
    assert got["a"].n == n and got["a"].ks == pytest.approx(ks, abs=1e-10) and got["a"].shapiro_francia == pytest.approx(w, abs=1e-10)
    assert got["b"].ks is None and got["b"].shapiro_francia is None and got["e"].ks is None and set(got) == {"a", "b", "e"}
    whole = stats.normality_by_order(df.where("g = 'a'"), "x").first()
    assert whole.ks == pytest.approx(ks, abs=1e-10)


def test_grouped_fit(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) * [1, 50, 0.01] + [0, 1000, 3]
    g = rng.integers(0, 3, 300)
    y = x @ [2.0, -0.5, 30.0] * (g + 1) + g + rng.normal(size=300)
    rows = [(int(k), *map(float, r), float(v)) for k, r, v in zip(g, x, y)] + [(0, None, 1.0, 1.0, 1.0), (7, 1.0, 2.0, 3.0, 4.0), (8, 1.0, 1.0, 1.0, 1.0)] + [(9, float(k), 2.0 * k, 1.0, 1.0 * k) for k in range(9)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, y double")
    got = {r.g: r for r in regression.grouped_fit(df, ["g"], ["a", "b", "c"], "y").collect()}
    for k in range(3):
        own = np.column_stack([np.ones((g == k).sum()), x[g == k]])
        beta, *_ = np.linalg.lstsq(own, y[g == k], rcond=None)
        assert [got[k].intercept, got[k].a, got[k].b, got[k].c] == pytest.approx(beta.tolist(), rel=1e-6)
        rest = y[g == k] - own @ beta
        assert got[k].r2 == pytest.approx(1 - (rest @ rest) / ((y[g == k] - y[g == k].mean()) ** 2).sum(), rel=1e-8)
    assert got[7].a is None and got[7].n == 1 and got[9].a is None  # too few rows; features that depend on each other


def test_regular_series(spark):
    t = lambda h, m=0: dt.datetime(2024, 3, 9, 20) + dt.timedelta(hours=h, minutes=m)
    rows = [("a", t(0, 5), 1, None), ("a", t(0, 50), 2, 5), ("a", t(3), None, 6), ("a", t(5), 4, None), ("b", t(1), 9, 9), (None, t(2), 7, 7), (None, t(4), 8, 8), ("a", None, 1, 1)]
    df = spark.createDataFrame(rows, "d string, ts timestamp_ntz, x int, y int")
    got = sorted(((r.d or "", r.slot, r.x, r.y, r.filled) for r in series.regular(df, ["d"], "ts", ["x", "y"]).collect()))
    want = [("", t(2), 7, 7, False), ("", t(3), 7, 7, True), ("", t(4), 8, 8, False), ("a", t(0), 2, 5, False), ("a", t(1), 2, 5, True), ("a", t(2), 2, 5, True),
            ("a", t(3), None, 6, False), ("a", t(4), None, 6, True), ("a", t(5), 4, None, False), ("b", t(1), 9, 9, False)]
    assert got == want
    long = spark.createDataFrame([("a", t(0), 1), ("a", t(30_000), 2)], "d string, ts timestamp_ntz, x int")
    out = series.regular(long, ["d"], "ts", ["x"])
    assert out.count() == 30_001 and out.where("x = 1").count() == 30_000


def test_regular_series_moves_readings_only(spark, monkeypatch):
    stored = []

    def watched(df):
        out = durable(df)
        stored.append(out.count())
        return out

    durable = ordered.durable
    monkeypatch.setattr(ordered, "durable", watched)
    t = lambda h: dt.datetime(2024, 3, 9) + dt.timedelta(hours=h)
    rows = spark.createDataFrame([(d, t(h), h) for d in range(20) for h in (0, 700)], "d int, ts timestamp_ntz, x int")
    out = series.regular(rows, ["d"], "ts", ["x"])
    assert out.count() == 20 * 701 and out.where("filled").agg(F.max("x")).first()[0] == 0
    assert stored == [40]  # no step is shuffled


def test_date_layout(spark):
    day = dt.date(2019, 1, 1)
    every = [day + dt.timedelta(days=k) for k in range(400)]
    monthly = [dt.date(1985 + m // 12, m % 12 + 1, 1) for m in range(60)]
    column = lambda days, form: spark.createDataFrame([(d.strftime(form),) for d in days] + [(None,), (" ",)], "t string")
    assert series.date_layout(column(every, "%m-%d-%Y"), "t") == "MM-dd-yyyy"
    assert series.date_layout(column(every, "%d-%m-%Y"), "t") == "dd-MM-yyyy"
    assert series.date_layout(column(monthly, "%m-%d-%Y"), "t") == "MM-dd-yyyy"
    assert series.date_layout(column(monthly, "%d-%m-%Y"), "t") == "dd-MM-yyyy"
    assert series.date_layout(column([dt.date(2020, 5, 5), dt.date(2020, 6, 6)], "%m-%d-%Y"), "t") == "MM-dd-yyyy"  # the same days either way
    with pytest.raises(ValueError, match="can be read as"):
        series.date_layout(column([dt.date(2020, 3, 4), dt.date(2020, 7, 9)], "%m-%d-%Y"), "t")
    with pytest.raises(ValueError, match="none of"):
        series.date_layout(spark.createDataFrame([("x",)], "t string"), "t")
