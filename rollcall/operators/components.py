"""Connected components by alternating small stars and large stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import cut


def connected_components(edges: DataFrame, max_rounds: int = 30) -> DataFrame:
    """Rows (node, component): each node of edges (a, b) with the least node it reaches.

    Each round links every node's larger neighbours to its least one, then its smaller
    neighbours and itself to the least; the number of rounds grows with the logarithm of
    the longest path, and no node's neighbours are gathered in a list. Null ends are no
    edges; loops give components of one. More rounds than max_rounds are an error, as the
    labels of an unfinished run would split components.
    """
    e = edges.select("a", "b").dropna().distinct()
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    pairs = cut(e.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        fresh = cut(down.union(small.select("u", F.col("m").alias("v"))).distinct())
        if fresh.count() == pairs.count() and fresh.exceptAll(pairs).isEmpty():
            break
        pairs = fresh
    else:
        raise RuntimeError(f"components have not converged in {max_rounds} rounds")
    label = pairs.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(label, nodes["node"] == label["u"], "left").select("node", F.coalesce("component", "node").alias("component"))
