"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.shared import staged


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Point a node's larger (or not larger) neighbours at its smallest one. The smallest
    is found by an aggregation, so a node's neighbours are never gathered."""
    both = edges
    if larger:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    met = both.join(least, "u")
    if larger:
        return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    own = least.select("u", F.col("m").alias("v"))
    rest = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for nodes of undirected edges ``u, v``: the label is the smallest
    node that can be reached. The smallest nodes themselves have no row.

    Large-star and small-star steps in turn, each staged, until nothing changes: a
    number of rounds that grows with the logarithm of the number of nodes.
    """
    edges = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    edges = staged(edges)
    before = None
    while True:
        edges = staged(_star(_star(edges, larger=True), larger=False))
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = state
