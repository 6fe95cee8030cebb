"""Stage tables: a corpus run as Parquet tables that a later run adds to, and a versioned write-back of the merge."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking, confidence, extract, merge, validate
from ..streaming.incremental import not_done

NODE_FACETS = ["entity_term", "measured_attribute", "state_or_change_qualifier", "entity_type"]
NODE_FIELDS = ["name", *NODE_FACETS, "annotator"]
EDGE_FIELDS = ["claim_strength", "negated", "fcm_weight", "annotation_confidence"]
#: Rows of the pointer table: nanoseconds of the write, and the version.
POINTER = "at bigint, version string"


class Stages:
    """Tables below one folder; a stage only computes rows whose key its table lacks."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str) -> DataFrame | None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        there = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        return self.spark.read.parquet(self.path(name)) if there else None

    def add(self, name: str, rows: DataFrame, key: str, compute) -> DataFrame:
        """Appends compute(rows without a result yet) and returns the whole table."""
        done = self.read(name)
        compute(rows if done is None else not_done(rows, done, key)).write.mode("append").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))


def run_corpus(spark: SparkSession, folder: str, documents: DataFrame, replies: DataFrame, most_characters: int | None = None) -> dict[str, DataFrame]:
    """documents(doc_id, text) and replies(doc_id, text) to one merged graph.

    Chunks and extracted graphs are stage tables: a run with more documents works on the new ones only. The merge
    reads all of them. A document without a usable reply has no nodes.
    """
    stages = Stages(spark, folder)
    chunks = stages.add("chunks", documents, "doc_id", lambda d: chunking.chunks(d, most_characters=most_characters))
    graphs = stages.add("graphs", replies, "doc_id", lambda r: extract.parsed_replies(r, "doc_id"))
    found = extract.normalized_graph(graphs, "doc_id")
    nodes = found["nodes"].withColumn("node", F.col("id"))
    edges = found["edges"].withColumnRenamed("id", "edge").withColumn("source_document", F.coalesce("source_document", F.concat(F.lit("doc:"), "graph_ord")))
    merged = merge.consolidate(nodes, edges, NODE_FACETS, NODE_FIELDS, EDGE_FIELDS)
    return merged | {"chunks": chunks, "dropped": found["dropped"]}


def write_back(spark: SparkSession, folder: str, nodes: DataFrame, edges: DataFrame) -> str:
    """Writes a merged graph as a new version if its integrity holds; a row added to the pointer table then names it.

    Nothing is overwritten, so a write that breaks off leaves the version before it current. Earlier versions stay.
    Returns the version; raises ValueError with the number of problems.
    """
    problems = validate.check_integrity(nodes.select(F.lit(0).alias("graph_ord"), F.col("new_id").alias("id")), edges.select(F.lit(0).alias("graph_ord"), F.col("edge_id").alias("id"), "subject", "object"))
    count = problems.count()
    if count:
        raise ValueError(f"{count} integrity problems; nothing was written")
    version = uuid.uuid4().hex
    nodes.write.parquet(f"{folder}/{version}/nodes")
    edges.write.parquet(f"{folder}/{version}/edges")
    spark.createDataFrame([(time.time_ns(), version)], POINTER).coalesce(1).write.mode("append").json(f"{folder}/current")
    return version


def current(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the latest version that a completed write-back named."""
    version = spark.read.schema(POINTER).json(f"{folder}/current").agg(F.max(F.struct("at", "version")).alias("last")).head()["last"]["version"]
    return spark.read.parquet(f"{folder}/{version}/nodes"), spark.read.parquet(f"{folder}/{version}/edges")


def markdown_table(df: DataFrame, columns: list[str], order: list, most: int = 50) -> str:
    """A report of at most `most` rows: bars escaped, line ends as spaces."""
    cell = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"\s*\n\s*", " "), r"\|", r"\\|")
    rows = df.orderBy(*order).limit(most).select(F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |")).alias("line")).collect()
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + "-|" * len(columns), *[r["line"] for r in rows]]) + "\n"


def confidence_report(claims: DataFrame, most: int = 25) -> str:
    """Bucket counts and what to review first."""
    counts = confidence.bucket_counts(claims, [])
    return "# Confidence\n\n" + markdown_table(counts, ["high", "medium", "low", "unscored"], []) + "\n" + markdown_table(claims.where("score is not null"), ["id", "score", "limited_by"], [F.asc("score"), F.asc("id")], most)
