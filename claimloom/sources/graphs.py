"""Graph files: listing, reading JSON and YAML into node and edge tables, and writing them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPAN = "array<struct<text:string,start_char:int,end_char:int,section:string>>"
NODE = f"struct<id:string,name:string,entity_type:string,entity_term:string,measured_attribute:string,state_or_change_qualifier:string,applied_to:array<struct<entity_type:string,entity_term:string>>,source_spans:{SPAN},annotator:string>"
EDGE = (
    "struct<id:string,subject:string,predicate:string,object:string,negated:boolean,claim_strength:string,original_sentence:string,source_document:string,"
    "philosophical_accounts:array<string>,mediation:struct<status:string,mediator_node_ids:array<string>,pathway_description:string>,"
    "moderation:struct<status:string,moderator_node_ids:array<string>,interaction_type:string>,"
    f"comparator:struct<status:string,comparator_type:string,comparator_description:string,comparator_node_id:string>,source_spans:{SPAN},fcm_weight:double,annotation_confidence:double>"
)
DOCUMENT = "struct<document_id:string,doi:string,title:string,authors:array<string>,year:int,journal:string,study_design:string,sample_size_value:double>"
GRAPH = f"struct<graph_id:string,schema_version:string,nodes:array<{NODE}>,edges:array<{EDGE}>,source_documents:array<{DOCUMENT}>>"
#: Reports and sidecars that lie beside graphs (fixed pattern).
NOT_GRAPHS = r"(?i)(\.report|\.confidence|\.agreement|merged_index|corpus_report|conversion_report|manifest)\.(json|ya?ml)$"


def list_graphs(spark: SparkSession, folder: str) -> DataFrame:
    """(graph_ord, path, content) of graph files, numbered in order of their paths."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{yaml,yml,json}").load(folder).where(~F.col("path").rlike(NOT_GRAPHS))
    order = files.select("path", F.row_number().over(Window.orderBy("path")).alias("graph_ord"))  # one task numbers paths, never contents
    return files.join(order, "path").select("graph_ord", "path", F.decode("content", "UTF-8").alias("content"))


def _as_json(batches):
    """YAML texts as JSON; a text that cannot be read becomes null."""
    import json

    import pyarrow as pa

    try:
        import yaml
    except ImportError:
        yaml = None
    for batch in batches:
        out = []
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            try:
                if path.lower().endswith(".json"):
                    value = json.loads(content)
                elif yaml is None:
                    raise RuntimeError("reading YAML graphs needs the yaml package")
                else:
                    value = yaml.safe_load(content)
                out.append(json.dumps(value, default=str) if isinstance(value, dict) else None)
            except (ValueError, RecursionError):
                out.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("graph_ord"), batch.column("path"), pa.array(out, pa.string())], ["graph_ord", "path", "json"])


def read_graphs(files: DataFrame) -> DataFrame:
    """(graph_ord, path, graph) of listed files; files that are no graph are left out."""
    text = files.select(F.col("graph_ord").cast("int").alias("graph_ord"), "path", "content").mapInArrow(_as_json, "graph_ord int, path string, json string")
    return text.where("json is not null").select("graph_ord", "path", F.from_json("json", GRAPH).alias("graph"))


def child(graphs: DataFrame, name: str) -> DataFrame:
    """nodes, edges or source_documents as a flat table with ordinals."""
    return graphs.select("graph_ord", F.posexplode(f"graph.{name}").alias("item_ord", "item")).where("item is not null").select("graph_ord", "item_ord", "item.*")


def nest(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Graphs with ordered node and edge arrays, as JSON lines for export."""
    pack = lambda df, name: df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("item_ord", F.struct(*[c for c in df.columns if c not in (*keys, "item_ord")]).alias("v")))), lambda x: x["v"]).alias(name))
    joined = pack(nodes, "nodes").join(pack(edges, "edges"), keys, "full")
    return joined.select(*keys, F.to_json(F.struct("nodes", "edges")).alias("graph"))
