import random

import pytest

from meterflow import skew
from meterflow.operators import graph, network
from meterflow.plans import supply

HOUSEHOLDS = [
    ("ash", "2031-03-04T06:00:00Z", 2.5, "mill", "south"), ("birch", "2031-03-04T06:30:00Z", 7.25, "quay", "east"),
    ("cedar", "2031-03-04T07:00:00Z", 1.125, "mill", "south"), ("elm", "2031-03-04T08:00:00Z", 3.0, "mill", "south"),
]
FIELDS = "household_id string, timestamp string, electricity_usage_kwh double, ward string, district string"


@pytest.fixture(scope="module")
def sample(spark):
    households = spark.createDataFrame(HOUSEHOLDS, FIELDS)
    transformers = spark.createDataFrame(
        [("T1", "south", "mill"), ("T2", "east", "quay")],
        "transformer_id string, district string, ward string",
    )
    return households, transformers


def test_sample_ranks(sample):
    ranks = {r.id: r.pagerank for r in supply.ranked(supply.supply_graph(*sample)).collect()}
    names = ["ash", "birch", "cedar", "elm", "T1", "T2"]
    want = plain_pagerank(6, [(0, 4), (1, 5), (2, 4), (3, 4)], 0.15, 10)
    assert [ranks[n] for n in names] == pytest.approx(want)
    assert list(ranks)[:2] == ["T1", "T2"]


def test_sample_components(sample):
    labels = {r.id: r.component for r in supply.grouped(supply.supply_graph(*sample)).collect()}
    assert labels == {"ash": "T1", "cedar": "T1", "elm": "T1", "T1": "T1", "birch": "T2", "T2": "T2"}


def test_repeated_readings_make_one_vertex_and_edge(sample):
    households, transformers = sample
    g = supply.supply_graph(households.unionByName(households), transformers)
    assert g.vertices.count() == 6 and g.edges.count() == 4


def test_failure(spark, sample):
    g = supply.supply_graph(*sample)
    for failed in (["T1"], spark.createDataFrame([("T1",), ("T1",), ("T9",)], "t string")):
        _, summary = supply.after_failure(g, failed)
        assert tuple(summary.first()) == (4, 1)


def test_supply_graph_checks_its_edges(sample, monkeypatch):
    monkeypatch.setattr(network, "vertices", lambda readings, transformers: transformers.selectExpr("transformer_id AS id"))
    with pytest.raises(ValueError, match="unknown vertices"):
        supply.supply_graph(*sample)
    assert supply.supply_graph(*sample, check=False).edges.count() == 4


def test_one_row_per_id_is_the_same_on_every_run(spark):
    rows = [(1, "b"), (1, "a"), (2, None)]
    for order in (rows, rows[::-1]):
        g = graph.Graph.of(spark.createDataFrame(order, "id long, name string"), spark.createDataFrame([], "src long, dst long"))
        assert sorted(map(tuple, g.vertices.collect()), key=str) == [(1, "b"), (2, None)]


@pytest.mark.parametrize("small", [True, False])
def test_edges_of_unknown_ends(spark, monkeypatch, small):
    monkeypatch.setattr(graph, "small_enough", lambda df: small)
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    edges = spark.createDataFrame([(1, i) for i in range(40)] + [(99, 1)], "src long, dst long")
    g = graph.Graph(spark.range(1, 30), edges)
    assert g.linked_edges().count() == 29 and g.dangling_edges().count() == 12


def test_lookup_joins_are_broadcast_when_small(sample):
    for joined in (network.connect(*sample), network.assign_transformer(*sample)):
        text = joined._sc._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "simple")
        assert "BroadcastHashJoin" in text


def test_a_doubled_place_does_not_double_readings(spark, sample):
    mapping = spark.createDataFrame([("T8", "south", "mill"), ("T7", "south", "mill")],
                                    "transformer_id string, district string, ward string")
    rows = network.assign_transformer(sample[0], mapping).collect()
    assert len(rows) == 4 and {r.transformer_id for r in rows} == {"T7", network.UNKNOWN}


def test_assign_with_default(spark, sample):
    mapping = spark.createDataFrame([("Station_9", "south", "mill")],
                                    "transformer_id string, district string, ward string")
    rows = network.assign_transformer(sample[0], mapping).collect()
    assert {r.household_id: r.transformer_id for r in rows} == {
        "ash": "Station_9", "cedar": "Station_9", "elm": "Station_9", "birch": "Unknown_Transformer",
    }


def test_availability(spark):
    df = spark.createDataFrame([(230,), (0,), (None,)], "voltage int")
    assert [r.availability for r in network.availability(df).collect()] == [1, 0, None]


def test_neighbour_edges_of_the_sample(spark):
    edges = network.neighbour_edges(spark.createDataFrame(HOUSEHOLDS, FIELDS))
    by_use = sorted((kwh, name) for name, _, kwh, ward, _ in HOUSEHOLDS if ward == "mill")
    want = {(*sorted((a, b)), y - x) for (x, a), (y, b) in zip(by_use, by_use[1:])}
    assert {tuple(r) for r in edges.collect()} == want


def test_given_edges_join_what_they_touch(spark):
    vertices = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "id string")
    edges = spark.createDataFrame([("z", "y", 0.5), ("z", "x", 2.0)], "src string, dst string, usage_diff double")
    labels = {r.id: r.component for r in graph.connected_components(vertices, edges).collect()}
    assert labels == {"x": "x", "y": "x", "z": "x", "w": "w"}


def test_dangling_edges(spark):
    vertices = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    edges = spark.createDataFrame([(1, 2), (1, 9)], "src long, dst long")
    with pytest.raises(ValueError, match="unknown vertices"):
        graph.Graph.of(vertices, edges)
    g = graph.Graph.of(vertices, edges, dangling="drop")
    assert g.vertices.count() == 2 and [tuple(r) for r in g.edges.collect()] == [(1, 2)]


def union_find(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return [root(i) for i in range(n)]


def shapes():
    rng = random.Random(5)
    yield "random", 60, [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    yield "path", 40, [(i, i + 1) for i in range(39)]
    yield "star", 50, [(49, i) for i in range(40)]
    yield "none", 4, []
    yield "loops", 4, [(0, 0), (1, 2), (2, 1)]


@pytest.mark.parametrize("name, n, edges", list(shapes()), ids=lambda v: v if isinstance(v, str) else "")
def test_components_match_union_find(spark, monkeypatch, name, n, edges):
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    vertices = spark.range(n)
    rows = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.component for r in graph.connected_components(vertices, rows).collect()}
    assert [got[i] for i in range(n)] == union_find(n, edges)


def plain_pagerank(n, edges, reset, rounds):
    out = [sum(1 for a, _ in edges if a == i) for i in range(n)]
    rank = [1.0] * n
    for _ in range(rounds):
        gain = [0.0] * n
        for a, b in edges:
            gain[b] += rank[a] / out[a]
        rank = [reset + (1 - reset) * g for g in gain]
    return [r * n / sum(rank) for r in rank]


@pytest.mark.parametrize("hot_rows", [100_000, 2])
def test_pagerank_matches_plain_python(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    rng = random.Random(3)
    n = 30
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(60)] + [(0, i) for i in range(n)] + [(1, 2)] * 3
    got = graph.pagerank(spark.range(n), spark.createDataFrame(edges, "src long, dst long"), max_iter=7)
    ranks = {r.id: r.pagerank for r in got.collect()}
    want = plain_pagerank(n, edges, 0.15, 7)
    assert [ranks[i] for i in range(n)] == pytest.approx(want)


def test_combined_vertices_pad_with_null(spark):
    ours = spark.createDataFrame([("h", "1", "w", "d", 1)],
                                 "household_id string, house_number string, ward string, district string, availability int")
    theirs = spark.createDataFrame([("T", "d", "w")], "transformer_id string, district string, ward string")
    rows = {r.id: r for r in network.combine_vertices(ours, theirs).collect()}
    assert rows["T"].house_number is None and rows["T"].ward == "w" and rows["h"].availability == 1


def test_load_counts_households_once(spark):
    df = spark.createDataFrame([("T", "a", 1.0), ("T", "a", 2.0), ("T", "b", 3.0)],
                               "transformer_id string, household_id string, electricity_usage_kwh double")
    assert tuple(network.transformer_load(df).first()) == ("T", 6.0, 3, 2)


def test_pagerank_to_a_tolerance(spark):
    rng = random.Random(21)
    names = [f"v{k}" for k in range(60)]
    links = [(rng.choice(names[:40]), rng.choice(names)) for _ in range(150)] + [("v0", "v1")] * 3 + [("v2", "nowhere")]
    ids = spark.createDataFrame([(n,) for n in names], "id string")
    edges = spark.createDataFrame(links, "src string, dst string")
    ranks, moved = graph.pagerank_to(ids, edges, reset=0.5, tolerance=1e-6)
    known = [(a, b) for a, b in links if b in names]
    out = {a: sum(x == a for x, _ in known) for a in names}
    want = dict.fromkeys(names, 0.5)
    for _ in range(300):
        gain = dict.fromkeys(names, 0.0)
        for a, b in known:
            gain[b] += want[a] / out[a]
        want = {n: 0.5 + 0.5 * gain[n] for n in names}
    scale = len(names) / sum(want.values())
    got = {r.id: r.pagerank for r in ranks.collect()}
    assert set(got) == set(names) and max(abs(got[n] - want[n] * scale) for n in names) < 1e-5
    rows = sorted(moved.collect(), key=lambda r: r["round"])
    assert rows[0].frontier == 60 and rows[-1].frontier < rows[0].frontier and rows[-1].sent <= rows[0].sent
    with pytest.raises(RuntimeError, match="not within"):
        graph.pagerank_to(ids, edges, tolerance=1e-9, max_rounds=4)


def test_components_of_edges_alone(spark):
    """Without a vertex table the ends are the vertices, those of loops too; edges without an end are none."""
    edges = [(f"h{k % 3}", f"leaf{k}") for k in range(60)] + [(f"p{k:02d}", f"p{k + 1:02d}") for k in range(30)]
    edges += [("p05", "p04"), ("p05", "p04"), ("lone", "lone"), (None, "p01"), ("h0", None), (None, None)]
    got = {r.id: r.component for r in graph.connected_components(None, spark.createDataFrame(edges, "src string, dst string")).collect()}
    want = {f"leaf{k}": f"h{k % 3}" for k in range(60)} | {f"h{k}": f"h{k}" for k in range(3)} | {f"p{k:02d}": "p00" for k in range(31)} | {"lone": "lone"}
    assert got == want
