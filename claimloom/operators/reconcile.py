"""Reconciling new nodes with an existing graph: identity, then anchored similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import containment_score, looks_like_identifier, norm, plain_tokens

MIN_SCORE = 0.7
_FACETS = ["entity_term", "measured_attribute", "qualifier", "entity_type"]


def _folded(df: DataFrame, side: str) -> DataFrame:
    return df.select(
        F.col("id").alias(f"{side}_id"), F.col("ord").alias(f"{side}_ord"), F.col("entity_term").alias(f"{side}_term"),
        *[norm(F.col(c)).alias(f"{side}_{c}" if c == "measured_attribute" else f"k_{c}") for c in _FACETS],
    )


def reconcile(new: DataFrame, existing: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(new_id, existing_id, rule, score) for new nodes that have a match; nodes: id, ord and the four facets.

    Rule `identity`: all facets equal; of equal existing nodes the last wins. Else the anchor (term, qualifier,
    type) must be equal and the attributes alike by at least min_score: equal 1, one side empty min_score itself;
    the first best wins. Attributes are scored once for each anchor, however many nodes bear them. The rule is `grounded` if the term is an identifier, else `lexical`. Anchors that differ
    never match, whatever the score.
    """
    a, b = _folded(new, "new"), _folded(existing, "old")
    keys = ["k_entity_term", "k_qualifier", "k_entity_type"]
    last = b.groupBy(*keys, "old_measured_attribute").agg(F.max_by("old_id", "old_ord").alias("old_id"))
    exact = a.join(last, [*[a[k] == last[k] for k in keys], a["new_measured_attribute"] == last["old_measured_attribute"]]).select("new_id", F.col("old_id").alias("existing_id"), F.lit("identity").alias("rule"), F.lit(1.0).alias("score"))
    named = F.col("k_entity_term") != ""
    asked = a.where(named).select(*keys, "new_measured_attribute").distinct().withColumn("x", plain_tokens(F.col("new_measured_attribute")))
    held = b.where(named).groupBy(*keys, "old_measured_attribute").agg(F.min(F.struct("old_ord", "old_id")).alias("first")).withColumn("y", plain_tokens(F.col("old_measured_attribute")))
    x, y = F.col("new_measured_attribute"), F.col("old_measured_attribute")
    score = F.when(x == y, 1.0).when((x == "") | (y == ""), min_score).otherwise(containment_score(F.col("x"), F.col("y")))
    scored = asked.join(held, keys).withColumn("score", score).where(F.col("score") >= min_score)
    best = scored.groupBy(*keys, "new_measured_attribute").agg(F.min(F.struct((-F.col("score")).alias("s"), "first.old_ord", "first.old_id")).alias("b"))
    rule = F.when(looks_like_identifier(F.col("new_term")), "grounded").otherwise("lexical")
    found = a.join(exact.select("new_id"), "new_id", "left_anti").join(best, [*keys, "new_measured_attribute"])
    return exact.unionByName(found.select("new_id", F.col("b.old_id").alias("existing_id"), rule.alias("rule"), F.round(-F.col("b.s"), 3).alias("score")))


def adopt(new: DataFrame, existing: DataFrame, matches: DataFrame, fields: list[str]) -> DataFrame:
    """New nodes with their match's id and, where it has them, its fields."""
    old = existing.select(F.col("id").alias("existing_id"), *[F.col(c).alias(f"_{c}") for c in fields])
    joined = new.join(matches.select(F.col("new_id").alias("id"), "existing_id"), "id", "left").join(old, "existing_id", "left")
    kept = [c for c in new.columns if c not in ("id", *fields)]
    return joined.select(F.coalesce("existing_id", "id").alias("id"), *[F.coalesce(f"_{c}", c).alias(c) for c in fields], *kept)
