"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).head()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b); component is the smallest node that it can reach.

    Each step is a partial aggregation and a join, so a node with very many edges is not gathered in one task.
    Edges with a null end and loops are ignored; repeated edges count once; no edges give an empty result.
    """
    edges = staged(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).unionByName(joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = staged(small, "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
