"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Alternates large stars (a node's larger neighbours are hung on its smallest one) and small
    stars (its smaller neighbours, and itself, are), each a partial-aggregated minimum and a join,
    until a round changes nothing; the number of rounds grows with the logarithm of the longest
    chain. Every round is written to the shared folder, which cuts the lineage.
    """
    ordered = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    while True:
        large = _stars(ordered, larger=True)
        small = stored(_stars(large, larger=False), "stars")
        # Edges point from larger to smaller; a star forest has no edge whose end has one too.
        chained = small.join(small.select(F.col("u").alias("v")), "v", "left_semi")
        several = small.groupBy("u").count().filter("count > 1")
        if chained.isEmpty() and several.isEmpty():
            break
        ordered = small
    leaves = small.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v; hot nodes are folded before the shuffle."""
    if larger:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    joined = near.join(least, "u")
    if larger:
        joined = joined.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        joined = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
    return joined.filter("u <> v").distinct()
