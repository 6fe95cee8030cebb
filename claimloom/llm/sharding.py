"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard: at each node it goes to the child with the least draw. A shard draws
-ln(u) / weight from a hash of the document's id and the shard's name; a rack or region has the least draw of its
shards, which is a draw with the sum of their weights. Each child thus gets documents in proportion to its weight, and
if a shard's weight grows, or a shard is added, documents move only into that shard; what goes on inside other subtrees
stays. One rule gives the tree of any number of shards: racks of two, regions of two racks.

Defined results: null texts have no bytes (size 1, crc32 of nothing). A null doc_id is an id like any other; rows
with one id share a shard, whatever their text. Slots number a shard's rows without gaps by hashed bucket, doc_id
and text hash; identical rows may trade slots. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
#: Parts of a shard that are numbered on their own; also bounds the broadcast table of their sizes.
BUCKETS = 1024


@dataclass
class Node:
    """A region, a rack, or with a shard number a leaf."""

    name: str
    children: list[Node] = field(default_factory=list)
    shard: int | None = None
    own_weight: float = 1.0


def topology(shards: int) -> Node:
    """Shards in racks of two and regions of two racks; the last ones may hold fewer."""
    root = Node("root")
    for s in range(shards):
        if s % 4 == 0:
            root.children.append(Node(f"region{s // 4}"))
        region = root.children[-1]
        if s % 2 == 0:
            region.children.append(Node(f"{region.name}/rack{s // 2}"))
        rack = region.children[-1]
        rack.children.append(Node(f"{rack.name}/{s}", shard=s))
    return root


def _draw(key, node: Node):
    if node.children:
        drawn = [_draw(key, x) for x in node.children]
        return F.least(*drawn) if len(drawn) > 1 else drawn[0]
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11).cast("double") + 1) / float(1 << 53)
    return -F.log(u) / F.lit(float(node.own_weight))


def shard_of(key, node: Node):
    """The shard that a key reaches below a node, as a column expression."""
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return shard_of(key, node.children[0])
    drawn = [_draw(key, x) for x in node.children]
    least = F.least(*drawn)
    chosen = None
    for x, d in zip(node.children, drawn, strict=True):
        below = shard_of(key, x)
        chosen = F.when(d == least, below) if chosen is None else chosen.when(d == least, below)
    return chosen


def shard_documents(docs: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of docs(doc_id, text)."""
    key = F.col("doc_id")
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    bucket = F.pmod(F.xxhash64(key, F.lit("bucket")), F.lit(buckets)).cast("int")
    placed = docs.select("doc_id", (F.octet_length(bytes_) + 1).cast("bigint").alias("size"), F.crc32(bytes_).alias("text_crc32"), shard_of(key, topology(shards)).cast("int").alias("shard"), bucket.alias("bucket"))
    sizes = docs.select(shard_of(key, topology(shards)).cast("int").alias("shard"), bucket.alias("bucket")).groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1).join(F.broadcast(firsts), ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("place")).cast("bigint").alias("slot"), shard_of(key, topology(shards + 1)).cast("int").alias("grown_shard"))
