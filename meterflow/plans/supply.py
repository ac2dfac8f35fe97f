"""Supply graph: households, transformers, ranks, components, what-ifs."""

from ..operators import graph, network


def supply_graph(readings, transformers, check=True):
    """The graph of households and the transformers that feed them.

    Readings repeat a household over time; its edge is kept once. ``check``
    makes sure that no edge points to an unknown vertex, which takes a pass.
    """
    edges = network.connect(readings.select("household_id", "district", "ward").distinct(), transformers)
    make = graph.Graph.of if check else graph.Graph
    return make(network.vertices(readings, transformers), edges.distinct())


def ranked(g, reset=0.15, max_iter=10):
    return graph.rank_table(graph.pagerank(g.vertices, g.edges, reset, max_iter))


def grouped(g):
    return graph.component_table(graph.connected_components(g.vertices, g.edges))


def after_failure(g, failed_ids):
    """(edges, supply summary) with the given transformers out."""
    edges = network.simulate_failure(g.edges, failed_ids)
    return edges, network.supply_summary(edges)
