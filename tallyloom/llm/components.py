"""Connected components of a graph of long ids by alternating star contractions.

Every round is two shuffles over the edges that are left and is written to the shared folder, so a
lost executor costs one round. A hub's edges are never gathered: its smallest neighbour comes from
an aggregation that combines on the map side and is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.workspace import stage

ROUNDS = 64


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least")).select("src", F.least("src", "least").alias("least"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and the node itself are linked to the smallest of them. Edges point down."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    moved = edges.join(least, "src").where("dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.unionByName(least.select("src", F.col("least").alias("dst")))


def _fingerprint(edges: DataFrame) -> tuple:
    mark = F.xxhash64("src", "dst")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(mark), F.lit(0)), F.max("src")).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component``: for every node that has an edge, the smallest node it can reach.

    ``edges`` has long columns ``src`` and ``dst`` in any direction, repeats and loops allowed.
    """
    down = edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = stage(down.distinct(), "components")
    seen = _fingerprint(now)
    for _ in range(ROUNDS):
        if not seen[0]:
            break
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "components")
        before, seen = seen, _fingerprint(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)
