"""Set-similarity joins through shared tokens, and what is decided from their scores.

A positive overlap needs a shared token, so an equi-join on exploded tokens finds every pair that can score; the
shared count and the two set sizes give the exact score. Strings equal after folding but without tokens meet
through a token of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _exploded(df: DataFrame, id_: str, words: Column, keys: list[str], side: str) -> DataFrame:
    named = df.select(F.col(id_).alias(f"{side}_id"), *keys, words.alias("_words"))
    return named.select(f"{side}_id", *keys, F.size("_words").alias(f"n_{side}"), F.explode("_words").alias("_word"))


def token_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_words: Column, right_words: Column, keys: list[str] | None = None, least_overlap: float = 0.0) -> DataFrame:
    """(left_id, right_id, n_left, n_right, n_shared) of pairs that share a token, and the keys where given.

    Pairs whose sizes alone keep their overlap below least_overlap are left out before they are counted: the shared
    tokens are at most the smaller set, the union at least the larger.
    """
    keys = keys or []
    a, b = _exploded(left, left_id, left_words, keys, "left"), _exploded(right, right_id, right_words, keys, "right")
    met = a.join(b, [*keys, "_word"])
    if least_overlap > 0:
        met = met.where(F.least("n_left", "n_right") / F.greatest("n_left", "n_right") >= least_overlap)
    return met.groupBy("left_id", "right_id", *keys, "n_left", "n_right").agg(F.count("*").alias("n_shared"))


def overlap() -> Column:
    return F.col("n_shared") / (F.col("n_left") + F.col("n_right") - F.col("n_shared"))


def containment(discount: float = 0.9) -> Column:
    whole = (F.col("n_left") == F.col("n_right")) & (F.col("n_shared") == F.col("n_left"))
    return F.when(whole, 1.0).otherwise(F.greatest(overlap(), F.col("n_shared") / F.least("n_left", "n_right") * discount))


def similar_pairs(pairs: DataFrame, score: Column, at_least: float) -> DataFrame:
    return pairs.withColumn("score", score).where(F.col("score") >= at_least)


def best_match(pairs: DataFrame, by: str, order: list[Column]) -> DataFrame:
    """The first pair of each `by` in this order."""
    return pairs.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("_rank = 1").drop("_rank")


def top_matches(pairs: DataFrame, by: str, order: list[Column], most: int = 5) -> DataFrame:
    """The first `most` pairs of each `by`, with their rank."""
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= most)


def one_to_one(candidates: DataFrame, score: str = "score") -> DataFrame:
    """Greedy matching in order of left_ord: each left row takes its best right row that none before it took.

    candidates(left_ord, right_id, score) should hold only pairs above the threshold. Rounds of window steps
    settle every left row whose choice no earlier open row can contest; each round settles at least one, and
    ties go to the smaller right_id. The candidates are computed once, not in every round.
    """
    keep = lambda df: df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()
    left = candidates = keep(candidates)
    settled: DataFrame | None = None
    while True:
        best = best_match(left, "left_ord", [F.desc(score), F.asc("right_id")])
        earliest = left.groupBy("right_id").agg(F.min("left_ord").alias("_first"))
        sure = best.join(earliest, "right_id").where("left_ord = _first").drop("_first")
        sure = keep(sure)
        if sure.isEmpty():
            return candidates.limit(0) if settled is None else settled
        settled = sure if settled is None else settled.unionByName(sure)
        left = left.join(sure.select("left_ord"), "left_ord", "left_anti").join(sure.select("right_id"), "right_id", "left_anti")


def routed(backends: list[tuple[int, DataFrame]], exact: float = 0.999) -> DataFrame:
    """Best hit of each term over ranked backends; a later backend sees only terms without a near-exact hit.

    Each backend is (rank, hits(term, curie, label, score)). Equal scores go to the earlier backend, then to the
    smaller curie.
    """
    found: DataFrame | None = None
    done: DataFrame | None = None
    for rank, hits in sorted(backends, key=lambda x: x[0]):
        if done is not None:
            hits = hits.join(done, "term", "left_anti")
        hits = hits.withColumn("route", F.lit(rank))
        found = hits if found is None else found.unionByName(hits)
        near = hits.where(F.col("score") >= exact).select("term").distinct()
        done = near if done is None else done.unionByName(near)
    return best_match(found, "term", [F.desc("score"), F.asc("route"), F.asc("curie")])


def with_fallback(primary: DataFrame, *others: DataFrame, key: str = "term") -> DataFrame:
    """Rows of the first table that has the key."""
    out = primary
    for other in others:
        out = out.unionByName(other.join(out.select(key).distinct(), key, "left_anti"))
    return out
