"""Connected components of links between 64-bit ids, by joining trees."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..durable import durable
from ..shipping import mapped
from .blobs import runs

_KIND = "node long, root long, moved boolean"


def components(links, a="a", b="b", max_rounds=100):
    """(node, root): every node that has a link and can reach a smaller one, with
    the smallest it can reach.

    Rows point from a node to a smaller one it is connected with. Every task turns
    its rows into trees of depth one; then the rows of a node meet in one task and
    their trees are joined; then every row follows the pointer of its root. That is
    repeated until a round moves no pointer. A task sends one row per node at most,
    so a hub costs no more than other nodes.
    """
    rows = links.select(F.col(a).alias("node"), F.col(b).alias("root"), F.lit(False).alias("moved")).where("node <> root")
    for _ in range(max_rounds):
        trees = durable(rows.transform(mapped, _trees, _KIND).repartition("node").transform(mapped, _trees, _KIND))
        if trees.where("moved").isEmpty():
            return trees.select("node", "root")
        above = trees.select(F.col("node").alias("root"), F.col("root").alias("to"))
        rows = trees.join(above, "root", "left").select("node", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved"))
    raise RuntimeError("components did not settle")


def _trees(batches):
    """(node, root, moved) of the trees of depth one that the rows of a partition
    join; ``moved`` if a row had moved, or if the trees are not just the rows."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if len(batch)]
    if not parts:
        return
    u, v, was = (np.concatenate(c) for c in zip(*parts, strict=True))
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = np.split(at.ravel(), 2)
    root = _smallest(len(node), u, v)
    below = np.flatnonzero(root != np.arange(len(node)))
    # Unmoved rows point to the roots already.
    moved = bool(was.any() or (root[u] != v).any())
    yield pa.RecordBatch.from_arrays(
        [pa.array(node[below]), pa.array(node[root[below]]), pa.array(np.full(len(below), moved))], names=["node", "root", "moved"]
    )


def _smallest(n, u, v):
    """For each of ``n`` nodes the smallest that the edges connect it with."""
    root = np.arange(n)
    while True:
        x, y = root[u], root[v]
        apart = x != y
        if not apart.any():
            return root
        u, v = u[apart], v[apart]
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        # Every root takes the smallest root that an edge leads to.
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first, _ = runs(high)
        root[high[first]] = low[first]
        while True:
            after = root[root]
            if (after == root).all():
                break
            root = after
