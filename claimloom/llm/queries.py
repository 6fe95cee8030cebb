"""The operators of this subpackage as driver queries over the synthetic tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import digests, format_conversations
from .html_extract import extract_main_text
from .license_scan import scan_licenses
from .ngram_jaccard import jaccard_components
from .packing import pack_documents
from .piece_codec import encode_texts
from .quality_classifier import classify_quality
from .quality_rules import quality_rules
from .sharding import shard_documents
from .vector_search import nearest_neighbours


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary lies: in the folder CLAIMLOOM_TOKENIZERS, else where its package has it."""
    folder = os.environ.get("CLAIMLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string")
    return digests(format_conversations(said.unionByName(probe)))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and the crc32 of what they decode to."""
    model = tokenizer_path("piece_bpe_32k.model")
    coded = encode_texts(_table(spark, sf_dir, "documents"), model, decoded="text")
    return coded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_ids"), F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    """None of these operators can be written in SQL; tests/llm holds them against brute force."""
    return {}
