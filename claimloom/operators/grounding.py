"""Grounding free-text terms: overrides, routed vocabularies, tail backoff, and writing the results back to nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SYNONYM_DISCOUNT, backoff_tails, label_variants, looks_like_identifier, norm, tokens
from .matching import best_match, overlap, routed, token_join, with_fallback

MIN_SCORE = 0.6
BACKOFF_PENALTY, BACKOFF_CAP = 0.15, 0.95


def vocabulary_hits(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, curie, label, score) of terms(term) against vocabulary(curie, label, synonyms).

    A label counts fully, a synonym at a discount; labels also match without a classifying last word. Every pair
    that shares a token is scored, no other can score.
    """
    named = vocabulary.select("curie", "label", F.explode(label_variants(F.col("label"))).alias("name"), F.lit(1.0).alias("weight"))
    synonyms = vocabulary.select("curie", "label", F.explode("synonyms").alias("synonym")).select("curie", "label", F.explode(label_variants(F.col("synonym"))).alias("name"), F.lit(SYNONYM_DISCOUNT).alias("weight"))
    entries = named.unionByName(synonyms).withColumn("entry", F.struct("curie", "label", "name", "weight"))
    pairs = token_join(terms.distinct(), entries, "term", "entry", tokens(F.col("term")), tokens(F.col("name")))
    scored = pairs.select(F.col("left_id").alias("term"), "right_id.curie", "right_id.label", (overlap() * F.col("right_id.weight")).alias("score"))
    return scored.groupBy("term", "curie", "label").agg(F.max("score").alias("score"))


def ground_terms(terms: DataFrame, vocabularies: list[tuple[int, DataFrame]], overrides: DataFrame | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """(term, curie, label, score, via) for terms(term); identifiers are left alone.

    An override of the folded term wins outright. Else the best hit over ranked vocabularies counts if it reaches
    min_score. Else the tails of the phrase are tried, longest first, at a higher threshold.
    """
    open_ = terms.select("term").where(~looks_like_identifier(F.col("term")) & (F.trim("term") != "")).distinct()
    found = []
    if overrides is not None:
        fixed = open_.withColumn("key", norm(F.col("term"))).join(F.broadcast(overrides.select(norm(F.col("term")).alias("key"), "curie", "label")), "key")
        found.append(fixed.select("term", "curie", "label", F.lit(1.0).alias("score"), F.lit("override").alias("via")))
    best = lambda t: routed([(rank, vocabulary_hits(t, v)) for rank, v in vocabularies])
    whole = best(open_).where(F.col("score") >= min_score).select("term", "curie", "label", "score", F.lit("phrase").alias("via"))
    missed = open_.join(whole.select("term"), "term", "left_anti")
    tails = missed.select(F.col("term").alias("phrase"), F.posexplode(backoff_tails(F.col("term"))).alias("tail_no", "term"))
    hits = best(tails.select("term")).where(F.col("score") >= min(BACKOFF_CAP, min_score + BACKOFF_PENALTY))
    backed = best_match(tails.join(hits, "term"), "phrase", [F.asc("tail_no")])
    found += [whole, backed.select(F.col("phrase").alias("term"), "curie", "label", "score", F.lit("tail").alias("via"))]
    return with_fallback(*found)


def ground_column(df: DataFrame, matches: DataFrame, column: str) -> DataFrame:
    """Replaces terms by the compact URI that they were grounded to."""
    one = matches.select(F.col("term").alias(column), F.col("curie").alias("_curie"))
    return df.join(one, column, "left").withColumn(column, F.coalesce("_curie", column)).drop("_curie")


def plain_column(df: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """The reverse: identifiers become labels(curie, label)."""
    one = labels.select(F.col("curie").alias(column), F.col("label").alias("_label"))
    return df.join(one, column, "left").withColumn(column, F.coalesce("_label", column)).drop("_label")


def grounding_counts(terms: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct terms, identifiers, hits by way and misses."""
    joined = terms.select("term").distinct().join(matches, "term", "left")
    identifier = looks_like_identifier(F.col("term"))
    counts: list[Column] = [F.count("*").alias("terms"), F.count_if(identifier).alias("identifiers"), F.count("curie").alias("matched"), F.count_if(F.col("curie").isNull() & ~identifier).alias("missed")]
    return joined.agg(*counts, *[F.count_if(F.col("via") == v).alias(v) for v in ("override", "phrase", "tail")])
