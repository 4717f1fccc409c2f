"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Nodes of ``edges(a, b)`` with the smallest node reachable: ``(node, component)``.

    Each round hangs the larger neighbours of a node on its smallest neighbour
    (large star), then the smaller ones and itself (small star), after Kiveris et
    al. 2014, "Connected components in MapReduce and beyond". Minima are combined
    before the shuffle, so a node with very many links is no bottleneck, and the
    joins back are plain equi-joins that adaptive execution can split. Nodes
    without links do not appear. Null ends are ignored.
    """
    edges = materialize(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
    for _ in range(max_rounds if state[0] else 0):
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        edges = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = materialize(
            edges.join(low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == state:
            break
        state = now
    else:
        if state[0]:
            raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )
