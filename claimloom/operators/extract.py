"""From replies to normalised graphs: recorded replies stand in for a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import EDGE_PREFIX, NODE_PREFIX, stable_id
from ..functions.text import json_object
from ..sources.graphs import EDGE, NODE
from .normalize import drop_dangling, resolve_endpoints


def parsed_replies(replies: DataFrame, key: str) -> DataFrame:
    """(key, graph) with the first object of each reply as nodes and edges; null where there is none.

    Slots that the schema lacks are dropped.
    """
    return replies.select(key, F.from_json(json_object(F.col("text")), f"struct<nodes:array<{NODE}>,edges:array<{EDGE}>>").alias("graph"))


def raw_items(parsed: DataFrame, key: str, name: str) -> DataFrame:
    """nodes or edges with their place in the reply."""
    return parsed.select(F.col(key).alias("graph_ord"), F.posexplode(f"graph.{name}").alias("item_ord", "item")).where("item is not null").select("graph_ord", "item_ord", "item.*")


def normalized_graph(parsed: DataFrame, key: str) -> dict[str, DataFrame]:
    """Nodes with ids, edges whose endpoints are known, and the edges that were dropped.

    Missing ids are hashed from content; endpoints may be original ids, new ids or node names.
    """
    nodes = raw_items(parsed, key, "nodes").withColumnRenamed("id", "raw_id")
    facets = [F.col(c) for c in ("entity_type", "entity_term", "measured_attribute", "state_or_change_qualifier")]
    nodes = nodes.withColumn("id", F.coalesce(F.nullif("raw_id", F.lit("")), stable_id(NODE_PREFIX, *facets)))
    edges = resolve_endpoints(raw_items(parsed, key, "edges"), nodes, ["subject", "object"])
    own = stable_id(EDGE_PREFIX, F.col("subject"), F.col("predicate"), F.col("object"), F.col("original_sentence"))
    edges = edges.withColumn("id", F.coalesce(F.nullif("id", F.lit("")), own))
    kept, dropped = drop_dangling(edges, nodes)
    return {"nodes": nodes, "edges": kept, "dropped": dropped}
