"""The corpus pipeline: classify quality, apply quality rules, keep one of near-duplicates, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.ngram_jaccard import jaccard_components
from claimloom.llm.packing import pack_documents
from claimloom.llm.quality_classifier import in_fold, train_classifier, with_scores
from claimloom.llm.quality_rules import quality_rules
from claimloom.llm.queries import tokenizer_path
from claimloom.llm.staging import staged


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1; texts that are null or empty are judged like any other."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~in_fold(F.col("doc_id"), 1)).select("doc_id", F.col("quality").alias("label"))
    vectors, network = train_classifier(docs, labels)
    score = _free(docs, "quality_score")
    return with_scores(docs, vectors, network, score).where(F.col(score) >= 0.5).select(*docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs do not have."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Every row with a number of its own, and that column's name; staged, as a row must keep its number when read again."""
    row = _free(docs, "row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep, whatever their doc_ids."""
    rows, row = _numbered(docs)
    rejected = quality_rules(rows.select(F.col(row).alias("doc_id"), "text", "lang")).where("not kept").select(F.col("doc_id").alias(row))
    return rows.join(rejected, row, "left_anti").select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows the one with the smallest doc_id; null ids come last."""
    rows, row = _numbered(docs)
    component = jaccard_components(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    ids = rows.select(row, "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", row)).alias("first")
    kept = component.join(ids, row).groupBy("component_id").agg(first).select(F.col(f"first.{row}").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality classifier", classified), ("quality rules", ruled), ("n-gram Jaccard join", deduplicated), ("packing", packed)]

#: SQL expresses none of the four stages; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
