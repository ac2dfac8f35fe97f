"""Supply network: joins, what-ifs, loads, ranks and components."""

from pyspark.sql import functions as F

from meterflow.operators import enrich, graph, network
from meterflow.plans import supply

from .registry import query
from .tables import READINGS_SQL, TRANSFORMERS_SQL, readings, table, transformers

BASE_SQL = f"{READINGS_SQL}, {TRANSFORMERS_SQL}"
EDGES_SQL = f"""{BASE_SQL},
edges AS (
  SELECT DISTINCT household_id AS src, transformer_id AS dst, CAST(1 AS INTEGER) AS availability
  FROM readings JOIN transformers USING (district, ward)
)"""
# Out of service in the what-if queries.
FAILED = ["T2-AUTOMOBILE", "T3-BUILDING", "T5-HOUSEHOLD", "T7-FURNITURE", "T11-HOUSEHOLD"]
FAILED_SQL = ", ".join(f"'{t}'" for t in FAILED)


@query("household_transformer_join", f"""
WITH {BASE_SQL}
SELECT household_id AS src, transformer_id AS dst, CAST(1 AS INTEGER) AS availability
FROM readings JOIN transformers USING (district, ward)
""")
def household_transformer_join(spark, sf_dir):
    return network.connect(readings(spark, sf_dir), transformers(spark, sf_dir))


@query("assign_transformer", f"""
WITH {BASE_SQL}
SELECT r.reading_id, r.household_id, coalesce(t.transformer_id, 'Unknown_Transformer') AS transformer_id
FROM readings r LEFT JOIN transformers t ON r.district = t.district AND r.ward = t.ward
""")
def assign_transformer(spark, sf_dir):
    rows = network.assign_transformer(readings(spark, sf_dir), transformers(spark, sf_dir))
    return rows.select("reading_id", "household_id", "transformer_id")


@query("neighbour_edges", f"""
WITH {READINGS_SQL},
newest AS (
  SELECT household_id, district, ward, electricity_usage_kwh AS kwh FROM readings
  QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY "timestamp" DESC, reading_id DESC) = 1),
linked AS (
  SELECT household_id AS a, kwh,
         lead(household_id) OVER w AS b, lead(kwh) OVER w AS next_kwh
  FROM newest WINDOW w AS (PARTITION BY district, ward ORDER BY kwh, household_id))
SELECT least(a, b) AS src, greatest(a, b) AS dst, round(next_kwh - kwh, 6) AS usage_diff
FROM linked WHERE b IS NOT NULL
""")
def neighbour_edges(spark, sf_dir):
    edges = network.neighbour_edges(readings(spark, sf_dir), tiebreak=["reading_id"])
    return edges.withColumn("usage_diff", F.round("usage_diff", 6))


@query("vertex_union", f"""
WITH {BASE_SQL}
SELECT household_id AS id FROM readings UNION SELECT transformer_id FROM transformers
""")
def vertex_union(spark, sf_dir):
    return network.vertices(readings(spark, sf_dir), transformers(spark, sf_dir))


@query("vertex_union_padded", f"""
WITH {BASE_SQL}
SELECT DISTINCT household_id AS id, house_number, ward, district, CAST(1 AS INTEGER) AS availability FROM readings
UNION ALL SELECT transformer_id, NULL, ward, district, NULL FROM transformers
""")
def vertex_union_padded(spark, sf_dir):
    households = network.availability(readings(spark, sf_dir))
    ours = households.select("household_id", "house_number", "ward", "district", "availability").distinct()
    return network.combine_vertices(ours, transformers(spark, sf_dir))


@query("failure_whatif", f"""
WITH {EDGES_SQL}
SELECT src, dst, CAST(CASE WHEN dst IN ({FAILED_SQL}) THEN 0 ELSE availability END AS INTEGER) AS availability
FROM edges
""")
def failure_whatif(spark, sf_dir):
    g = supply.supply_graph(readings(spark, sf_dir), transformers(spark, sf_dir))
    failed = spark.createDataFrame([(t,) for t in FAILED], "transformer_id string")
    return network.simulate_failure(g.edges, failed)


@query("supply_summary", f"""
WITH {EDGES_SQL}
SELECT count(DISTINCT src) AS total_households,
       count(DISTINCT CASE WHEN dst NOT IN ({FAILED_SQL}) THEN src END) AS supplied_households
FROM edges
""")
def supply_summary(spark, sf_dir):
    g = supply.supply_graph(readings(spark, sf_dir), transformers(spark, sf_dir))
    return supply.after_failure(g, FAILED)[1]


@query("transformer_load", f"""
WITH {BASE_SQL}
SELECT transformer_id, round(sum(electricity_usage_kwh), 4) AS total_usage,
       count(*) AS readings, count(DISTINCT household_id) AS households
FROM readings JOIN transformers USING (district, ward) GROUP BY transformer_id
""")
def transformer_load(spark, sf_dir):
    rows = network.assign_transformer(readings(spark, sf_dir), transformers(spark, sf_dir))
    known = rows.filter(F.col("transformer_id") != network.UNKNOWN)
    return network.transformer_load(known).withColumn("total_usage", F.round("total_usage", 4))


@query("pagerank_star", f"""
WITH {EDGES_SQL},
vertices AS (SELECT household_id AS id FROM readings UNION SELECT transformer_id FROM transformers),
raw AS (
  SELECT v.id, 0.15 + 0.85 * 0.15 * count(e.src) AS r
  FROM vertices v LEFT JOIN edges e ON e.dst = v.id GROUP BY v.id)
SELECT id, round(r * (SELECT count(*) / sum(r) FROM raw), 8) AS pagerank FROM raw
""")
def pagerank_star(spark, sf_dir):
    g = supply.supply_graph(readings(spark, sf_dir), transformers(spark, sf_dir))
    return supply.ranked(g).withColumn("pagerank", F.round("pagerank", 8))


@query("components_star", f"""
WITH {EDGES_SQL},
vertices AS (SELECT household_id AS id FROM readings UNION SELECT transformer_id FROM transformers),
hub AS (
  SELECT v.id, coalesce(e.dst, v.id) AS hub FROM vertices v LEFT JOIN edges e ON e.src = v.id)
SELECT id, min(id) OVER (PARTITION BY hub) AS component FROM hub
""")
def components_star(spark, sf_dir):
    g = supply.supply_graph(readings(spark, sf_dir), transformers(spark, sf_dir))
    return supply.grouped(g)


@query("components_of_neighbours", f"""
WITH {READINGS_SQL},
homes AS (SELECT DISTINCT household_id AS id, district, ward FROM readings)
SELECT id, min(id) OVER (PARTITION BY district, ward) AS component FROM homes
""")
def components_of_neighbours(spark, sf_dir):
    rows = readings(spark, sf_dir)
    edges = network.neighbour_edges(rows, tiebreak=["reading_id"])
    homes = rows.select(F.col("household_id").alias("id")).distinct()
    return graph.component_table(graph.connected_components(homes, edges))


def _trade(spark, sf_dir):
    """Who supplies whom: suppliers to customers of the same orders, by nation."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    pairs = lines.join(orders, "k").select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("src"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("dst"),
    )
    ids = pairs.select(F.col("src").alias("id")).unionByName(pairs.select(F.col("dst").alias("id")))
    return ids.distinct(), pairs


@query("pagerank_trade", """
WITH edges AS (
  SELECT concat('C', o_custkey) AS src, concat('S', l_suppkey) AS dst, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
outs AS (SELECT src, sum(n) AS o FROM edges GROUP BY src),
raw AS (
  SELECT src AS id, 0.15 AS r FROM outs
  UNION ALL
  SELECT dst, 0.15 + 0.85 * 0.15 * sum(CAST(n AS DOUBLE) / o) FROM edges JOIN outs USING (src) GROUP BY dst)
SELECT id, round(r * (SELECT count(*) / sum(r) FROM raw), 6) AS pagerank FROM raw
""")
def pagerank_trade(spark, sf_dir):
    vertices, edges = _trade(spark, sf_dir)
    return graph.rank_table(graph.pagerank(vertices, edges)).withColumn(
        "pagerank", F.round("pagerank", 6)
    )


@query("components_trade", """
WITH RECURSIVE pairs AS (
  SELECT DISTINCT concat('C', o_custkey) AS src, concat('S', l_suppkey) AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sym AS (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs),
lone AS (SELECT min(src) AS id FROM sym),
reach(id) AS (SELECT id FROM lone UNION SELECT b.dst FROM reach r JOIN sym b ON b.src = r.id)
SELECT DISTINCT src AS id, CASE WHEN src IN (SELECT id FROM reach) THEN (SELECT id FROM lone) END AS component FROM sym
""")
def components_trade(spark, sf_dir):
    edges = _trade(spark, sf_dir)[1]
    return graph.component_table(graph.connected_components(None, edges))


def _mixed_key(column):
    """Customer keys in an order unlike their own, so that a path's smallest id lies anywhere."""
    return (F.col(column).cast("long") * 48271) % 2147483647


@query("components_islands", """
WITH c AS (SELECT (c_custkey::BIGINT * 48271) % 2147483647 AS id, (c_custkey + 59) // 60 AS island FROM customer)
SELECT id, min(id) OVER (PARTITION BY island) AS component FROM c
""")
def components_islands(spark, sf_dir):
    """Customers in paths of sixty: many components of large diameter."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    ends = customer.filter("c_custkey % 60 <> 0").withColumn("next", F.col("c_custkey") + 1)
    known = customer.withColumnRenamed("c_custkey", "next")
    edges = ends.join(known, "next").select(_mixed_key("c_custkey").alias("src"), _mixed_key("next").alias("dst"))
    return graph.component_table(graph.connected_components(customer.select(_mixed_key("c_custkey").alias("id")), edges))


_HOPS_EDGES_SQL = """
edges AS (
  SELECT concat('C', c_custkey) AS src, concat('N', c_nationkey) AS dst FROM customer
  UNION ALL SELECT concat('S', s_suppkey), concat('N', s_nationkey) FROM supplier
  UNION ALL SELECT concat('N', n_nationkey), concat('R', n_regionkey) FROM nation
  UNION ALL SELECT concat('R', n_regionkey), concat('S', s_suppkey) FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _hops_sql(rounds=10):
    steps = ["r0 AS (SELECT id, 1.0::DOUBLE AS r FROM ids)"] + [
        f"r{k} AS (SELECT ids.id, 0.15 + 0.85 * coalesce(sum(r / o), 0) AS r FROM ids LEFT JOIN edges ON dst = ids.id "
        f"LEFT JOIN outs USING (src) LEFT JOIN r{k - 1} p ON p.id = src GROUP BY ids.id)"
        for k in range(1, rounds + 1)
    ]
    return f"""
WITH {_HOPS_EDGES_SQL},
ids AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
outs AS (SELECT src, count(*) AS o FROM edges GROUP BY src),
{", ".join(steps)}
SELECT id, round(r * (SELECT count(*) / sum(r) FROM r{rounds}), 6) AS pagerank FROM r{rounds}"""


def _hops(spark, sf_dir):
    """Customers to nations to regions to suppliers to nations: (vertex ids, edges)."""
    customer, supplier, nation = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation"))

    def named(letter, column):
        return F.concat(F.lit(letter), F.col(column))

    edges = customer.select(named("C", "c_custkey").alias("src"), named("N", "c_nationkey").alias("dst"))
    edges = edges.unionByName(supplier.select(named("S", "s_suppkey").alias("src"), named("N", "s_nationkey").alias("dst")))
    edges = edges.unionByName(nation.select(named("N", "n_nationkey").alias("src"), named("R", "n_regionkey").alias("dst")))
    placed = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    edges = edges.unionByName(placed.select(named("R", "n_regionkey").alias("src"), named("S", "s_suppkey").alias("dst")))
    return edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct(), edges


@query("pagerank_hops", _hops_sql())
def pagerank_hops(spark, sf_dir):
    """Ranks that change every round."""
    ids, edges = _hops(spark, sf_dir)
    return graph.rank_table(graph.pagerank(ids, edges)).withColumn("pagerank", F.round("pagerank", 6))


@query("pagerank_converged", f"""
WITH RECURSIVE {_HOPS_EDGES_SQL.strip()},
ids AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
outs AS (SELECT src, count(*) AS o FROM edges GROUP BY src),
shares AS (SELECT src, dst, count(*) / any_value(o) AS share FROM edges JOIN outs USING (src) GROUP BY src, dst),
passed(k, id, held) AS (
  SELECT 0, id, 0.5::DOUBLE FROM ids
  UNION ALL
  SELECT k + 1, dst, 0.5 * sum(share * held) FROM passed JOIN shares ON src = id WHERE k < 60 GROUP BY k, dst),
ranks AS (SELECT id, sum(held) AS r FROM passed GROUP BY id)
SELECT id, round(r * (SELECT count(*) / sum(r) FROM ranks), 4) AS pagerank FROM ranks
""")
def pagerank_converged(spark, sf_dir):
    """Ranks of the same graph, with a reset of one half, carried to their limit by a shrinking frontier."""
    ids, edges = _hops(spark, sf_dir)
    ranks, _ = graph.pagerank_to(ids, edges, reset=0.5, tolerance=1e-6)
    return ranks.withColumn("pagerank", F.round("pagerank", 4))


@query("unlinked_edges", f"""
WITH {EDGES_SQL}
SELECT src, dst FROM edges WHERE dst IN ({FAILED_SQL})
""")
def unlinked_edges(spark, sf_dir):
    """Edges that dangle once the failed transformers are removed as vertices."""
    g = supply.supply_graph(readings(spark, sf_dir), transformers(spark, sf_dir))
    left = graph.Graph(g.vertices.filter(~F.col("id").isin(FAILED)), g.edges)
    return left.dangling_edges().select("src", "dst")


@query("household_edges_with_parts", f"""
WITH {EDGES_SQL}
SELECT p.reading_id, e.dst, p.date_part FROM parts p JOIN edges e ON p.household_id = e.src
""")
def household_edges_with_parts(spark, sf_dir):
    """Readings joined back to their supply edge."""
    rows = enrich.add_time_parts(readings(spark, sf_dir))
    g = supply.supply_graph(rows, transformers(spark, sf_dir))
    edges = g.edges.select(F.col("src").alias("household_id"), "dst")
    return rows.join(edges, "household_id").select("reading_id", "dst", "date_part")


