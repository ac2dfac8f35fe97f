"""Property graphs on DataFrames: ranks and connected components.

Both algorithms pre-aggregate messages before every shuffle, split hubs with
``skew``, and store each round in the shared checkpoint folder.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import hashable_columns, require_columns
from ..durable import durable
from ..skew import hot_keys, key_profile, skew_join, small_enough, with_pieces


@dataclass(frozen=True)
class Graph:
    """Vertices (``id`` and attributes, one row per id) and edges (``src``, ``dst``)."""

    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self):
        require_columns(self.vertices, "id")
        require_columns(self.edges, "src", "dst")

    @classmethod
    def of(cls, vertices, edges, dangling="error"):
        """A graph with distinct vertex ids and no edge to an unknown vertex.

        ``dangling`` edges raise an error, or are removed with ``"drop"``.
        """
        graph = cls(_one_per_id(vertices), edges)
        if dangling == "drop":
            return cls(graph.vertices, graph.linked_edges())
        bad = graph.dangling_edges().limit(1).count()
        if bad:
            raise ValueError("edges point to unknown vertices")
        return graph

    def _flagged(self):
        """The edges with ``__src`` and ``__dst``: is that end a vertex?

        Vertex ids that are measured small are broadcast. Beyond the bound the
        edges are stored first, so that finding their hot keys and joining them
        twice does not run their plan again.
        """
        known = durable(self.vertices.select("id").distinct())
        small = small_enough(known)
        flagged = self.edges if small else durable(self.edges)
        hot = {} if small else {end: hot_keys(flagged, [end]) for end in ("src", "dst")}
        for end in ("src", "dst"):
            side = known.select(F.col("id").alias(end), F.lit(True).alias(f"__{end}"))
            if small:
                flagged = flagged.join(F.broadcast(side), [end], "left")
            else:
                flagged = skew_join(flagged, side, [end], "left", hot=hot[end])
        return flagged

    def linked_edges(self):
        """The edges whose two ends are vertices."""
        return self._flagged().filter("__src AND __dst").select(*self.edges.columns)

    def dangling_edges(self):
        """The edges with an end that is no vertex."""
        return self._flagged().filter("__src IS NULL OR __dst IS NULL").select(*self.edges.columns)


def _one_per_id(vertices):
    """One row per id: the greatest by its other columns, the same on every run."""
    rest = [c for c in vertices.columns if c != "id"]
    if not rest:
        return vertices.distinct()
    order = [c for c in hashable_columns(vertices) if c != "id"] or rest
    kept = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return vertices.groupBy("id").agg(kept).select("id", "__row.*").select(*vertices.columns)


def _partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pagerank(vertices, edges, reset=0.15, max_iter=10, checkpoint_every=5):
    """(id, pagerank) after ``max_iter`` rounds, scaled so that ranks sum to N.

    Every vertex starts at 1; a round gives ``reset + (1 - reset) * sum of the
    neighbours' rank / out-links``. Parallel edges count as several out-links.
    Edges with an end that is not a vertex do not take part.

    Edges are laid out and sorted once by source (hubs in pieces) and kept, so
    a round shuffles ranks and pre-summed contributions, never the edges.
    """
    if not 0 < reset <= 1 or max_iter < 1:
        raise ValueError("need 0 < reset <= 1 and max_iter >= 1")
    spark = vertices.sparkSession
    parts = _partitions(spark)
    ids = durable(vertices.select("id").distinct())
    links = edges.groupBy("src", "dst").agg(F.count("*").alias("n"))
    links = durable(Graph(ids, links).linked_edges())

    hot = hot_keys(links, ["src"])
    placed = with_pieces(links, ["src"], hot).withColumn("piece", F.pmod(F.xxhash64("src", "dst"), F.col("__pieces")).cast("int"))
    placed = placed.drop("__pieces").repartition(parts, "src", "piece").sortWithinPartitions("src", "piece").persist()
    out_links = links.groupBy(F.col("src").alias("id")).agg(F.sum("n").alias("out"))
    base = ids.join(out_links, "id", "left")
    base = base.repartition(parts, "id").sortWithinPartitions("id").persist()
    # Filled before the rounds are planned, so that their layout is known.
    placed.count()
    base.count()

    ranks = base.select("id", "out", F.lit(1.0).alias("pagerank"))
    try:
        for step in range(1, max_iter + 1):
            share = ranks.filter(F.col("out").isNotNull()).select(
                F.col("id").alias("src"), (F.col("pagerank") / F.col("out")).alias("share")
            )
            share = with_pieces(share, ["src"], hot)
            share = share.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))).drop("__pieces")
            gained = (
                placed.join(share, ["src", "piece"])
                .groupBy(F.col("dst").alias("id"))
                .agg(F.sum(F.col("share") * F.col("n")).alias("gain"))
            )
            ranks = base.join(gained, "id", "left").select(
                "id", "out",
                (F.lit(reset) + F.lit(1 - reset) * F.coalesce("gain", F.lit(0.0))).alias("pagerank"),
            )
            if step % checkpoint_every == 0 or step == max_iter:
                ranks = durable(ranks)
    finally:
        placed.unpersist()
        base.unpersist()
    size = ranks.agg(F.count("*").alias("n"), F.sum("pagerank").alias("s")).first()
    scale = size["n"] / size["s"] if size["n"] else 1.0
    return ranks.select("id", (F.col("pagerank") * F.lit(scale)).alias("pagerank"))


# Frontiers that are summed up at a time.
FOLD = 16


def pagerank_to(vertices, edges, reset=0.15, tolerance=1e-6, max_rounds=1000):
    """(ranks, moved): ranks within ``tolerance`` of the limit, and the rows moved per round.

    Ranks are those of ``pagerank`` after endlessly many rounds, scaled in the same way; before the scaling
    none is off by more than ``tolerance``. Every vertex starts with ``reset`` to pass on. A round takes what
    the vertices of the frontier hold into their ranks and passes ``1 - reset`` of it along their
    links; the next frontier is the vertices that received more than a bound. So the
    frontier shrinks, and vertices that are settled cost nothing. What falls under the bound is dropped: over all
    rounds at most ``tolerance * reset`` in sum, which can raise the ranks by ``tolerance`` at most.

    ``moved`` has a row per round: ``round``, ``frontier`` (vertices) and ``sent`` (link rows). Every frontier is
    stored, ``FOLD`` of them are folded into the ranks at a time; raises if ``max_rounds`` do not suffice.
    """
    if not 0 < reset <= 1 or not 0 < tolerance or max_rounds < 1:
        raise ValueError("need 0 < reset <= 1, a tolerance above 0 and max_rounds >= 1")
    spark = vertices.sparkSession
    ids = durable(vertices.select("id").distinct())
    size = ids.count()
    links = edges.groupBy("src", "dst").agg(F.count("*").alias("n"))
    links = Graph(ids, links).linked_edges()
    out = links.groupBy("src").agg(F.sum("n").alias("out"), F.count("*").alias("rows"))
    hot = hot_keys(links, ["src"])
    shares = durable(skew_join(links, out, ["src"], hot=hot).select("src", "dst", (F.col("n") / F.col("out")).alias("share")))
    counts = durable(out.select(F.col("src").alias("id"), "rows"))
    # Laid out once as the rounds join it, hubs in pieces; only what is passed on moves.
    on = ["src", "piece"] if hot else ["src"]
    parts = _partitions(spark)
    placed = with_pieces(shares, ["src"], hot).withColumn("piece", F.pmod(F.xxhash64("src", "dst"), F.col("__pieces")).cast("int")).drop("__pieces")
    placed = placed.repartition(parts, *on).sortWithinPartitions(*on).persist()
    placed.count()

    def senders(frontier):
        rows = frontier.select(F.col("id").alias("src"), "held")
        if not hot:
            return rows
        rows = with_pieces(rows, ["src"], hot)
        return rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))).drop("__pieces")
    # As many rounds as it takes the sum passed on to fall below the tolerance.
    needed, left = 1, float(size) * reset
    while left > tolerance * reset * reset / 2 and needed < max_rounds:
        needed, left = needed + 1, left * (1 - reset)
    bound = tolerance * reset / max(size, 1) / needed
    frontier = durable(ids.select("id", F.lit(reset).alias("held"), F.lit(0).alias("round")))
    folded, fresh = None, []
    for number in range(1, max_rounds + 1):
        fresh.append(frontier)
        passed = placed.join(senders(frontier), on).groupBy(F.col("dst").alias("id")).agg((F.sum(F.col("share") * F.col("held")) * (1 - reset)).alias("held"))
        frontier = durable(passed.where(F.col("held") > bound).withColumn("round", F.lit(number)))
        done = frontier.isEmpty()
        if done or len(fresh) == FOLD:
            log = reduce(DataFrame.unionByName, fresh).join(counts, "id", "left")
            log = log.groupBy("id").agg(F.sum("held").alias("held"), F.collect_list(F.struct("round", "rows")).alias("seen"))
            per_round = log.select(F.inline("seen")).groupBy("round").agg(F.count("*").alias("frontier"), F.sum(F.coalesce("rows", F.lit(0))).alias("sent"))
            log, per_round = durable(log.select("id", "held")), durable(per_round)
            folded = (log, per_round) if folded is None else tuple(a.unionByName(b) for a, b in zip(folded, (log, per_round), strict=True))
            fresh = []
        if done:
            break
    else:
        placed.unpersist()
        raise RuntimeError(f"ranks are not within {tolerance} after {max_rounds} rounds")
    placed.unpersist()
    log, moved = folded
    ranks = ids.join(log.groupBy("id").agg(F.sum("held").alias("pagerank")), "id", "left").select("id", F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"))
    total = ranks.agg(F.sum("pagerank")).first()[0]
    return ranks.select("id", (F.col("pagerank") * F.lit(size / total if total else 1.0)).alias("pagerank")), moved


def _turn(vertex, step):
    """A column's vertices in a pseudo-random order that is fresh to each round."""
    return F.struct(F.xxhash64(F.lit(step), F.col(vertex)).alias("turn"), F.col(vertex).alias("v"))


def _undirected(edges):
    """Every edge once, its smaller end first."""
    return edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def connected_components(vertices, edges, max_rounds=200):
    """(id, component) with the smallest vertex id as the component's label.

    ``vertices`` may be None: then they are the ends of the edges, and no edge has to be checked for unknown ones.

    Randomised contraction: in each round every vertex points to its first
    neighbour in a fresh random order, and joins the first of that one and the one it
    points to. Edges are rewritten to those representatives; loops and copies fall
    away. The number of vertices shrinks by a constant factor per round whatever the shape of
    the graph, and a hub with its leaves is gone in one. Edges are kept once, not
    in both directions, and pointers are followed over vertices, not over edges. The rounds' maps are
    then followed back from the last to the first.
    """
    live = durable(_undirected(edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL")))
    if vertices is None:
        ids = durable(live.select(F.explode(F.array("src", "dst")).alias("id")).distinct())
        live = live.filter("src <> dst")
    else:
        ids = durable(vertices.select("id").distinct())
        live = durable(Graph(ids, live.filter("src <> dst")).linked_edges())

    maps = []
    while True:
        both = live.unionByName(live.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        rows, hot = key_profile(both, ["src"])
        if not rows:
            break
        step = len(maps)
        if step == max_rounds:
            raise RuntimeError("components did not converge")
        near = durable(both.groupBy("src").agg(F.min(_turn("dst", step)).alias("near")))
        after = near.select(F.col("src").alias("at"), F.col("near").alias("after"))
        reach = skew_join(near.withColumn("at", F.col("near.v")), after, ["at"])
        chosen = durable(reach.select("src", F.least("near", "after").getField("v").alias("rep")))
        maps.append(chosen)
        moved = skew_join(live, chosen, ["src"], hot=hot).select(F.col("rep").alias("src"), "dst")
        far = chosen.select(F.col("src").alias("dst"), F.col("rep").alias("far"))
        moved = skew_join(moved, far, ["dst"], hot=hot).select("src", F.col("far").alias("dst"))
        live = durable(_undirected(moved.filter("src <> dst")))

    # Follow the maps back: (vertex, representative) of ever earlier rounds.
    found = None
    for chosen in reversed(maps):
        if found is None:
            found = chosen.select(F.col("src").alias("id"), "rep")
            continue
        later = found.select(F.col("id").alias("rep"), F.col("rep").alias("final"))
        found = skew_join(chosen, later, ["rep"], "left").select(
            F.col("src").alias("id"), F.coalesce("final", "rep").alias("rep")
        )
        found = durable(found)
    if found is None:
        return ids.select("id", F.col("id").alias("component"))
    labels = found.groupBy("rep").agg(F.min("id").alias("component"))
    named = skew_join(found, labels, ["rep"]).select("id", "component")
    return ids.join(named, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def rank_table(ranks):
    """Ranks, highest first."""
    return ranks.select("id", "pagerank").orderBy(F.col("pagerank").desc(), F.col("id").asc())


def component_table(components):
    """Vertices by component label."""
    return components.select("id", "component").orderBy("component", "id")
