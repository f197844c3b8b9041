"""Connected components of an edge table by alternating large and small stars.

Labels end as the least node of each component.  A round is two shuffles of an edge table
that never grows; the hub of a star is aggregated map-side, and the joins may be split, so a
component that holds a third of all nodes stays spread.  Rounds are logarithmic in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowverdict.sources.scratch import stored

MAX_ROUNDS = 100


def _with_least(pairs: DataFrame) -> DataFrame:
    """(node, other) with the least of the node and all its others."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    return pairs.join(least, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.select("node", "other").unionByName(
        edges.select(F.col("other").alias("node"), F.col("node").alias("other"))
    )
    tied = _with_least(both).filter(F.col("other") > F.col("node"))
    return tied.select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them; here node > other."""
    tied = _with_least(edges)
    pairs = tied.select(F.col("other").alias("node"), F.col("least").alias("other"))
    own = tied.select("node", F.col("least").alias("other"))
    return pairs.unionByName(own).filter(F.col("node") > F.col("other")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of all nodes that are not the least of their component.

    ``edges`` may hold loops, repeats and both directions; null ends are ignored.
    """
    current = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("other")
    )
    current, before = stored(current.distinct(), "edges"), None
    for _ in range(MAX_ROUNDS):
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return current.select("node", F.col("other").alias("component"))
        before = state
        current = stored(_small_star(_large_star(current)), "edges")
    raise RuntimeError("components did not settle")
