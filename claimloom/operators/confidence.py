"""Confidence from token log-probabilities: fields, items, claims, entropy, surprising passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLOOR = -100.0
HIGH, MEDIUM = 0.9, 0.6
WINDOW, KEPT = 48, 5


def clipped(logprob: Column) -> Column:
    """Infinite, missing and undefined values count as the floor."""
    return F.when(logprob.isNull() | F.isnan(logprob) | (F.abs(logprob) == float("inf")), F.lit(FLOOR)).otherwise(logprob)


def probability(logprob: Column) -> Column:
    return F.exp(F.greatest(logprob, F.lit(FLOOR)))


def bucket(score: Column) -> Column:
    return F.when(score.isNull(), "unscored").when(score >= HIGH, "high").when(score >= MEDIUM, "medium").otherwise("low")


def score_fields(tokens: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Field scores of tokens(keys, kind, token, logprob, order): decisions jointly, phrases per token."""
    lp = clipped(F.col("logprob"))
    scored = tokens.groupBy(*keys, "kind").agg(
        F.sum(lp).alias("joint"), F.avg(lp).alias("mean"), F.min(lp).alias("least"), F.count("*").alias("tokens"),
        F.min_by("token", F.struct(lp.alias("lp"), *order)).alias("pivot"),
    )
    p = F.when(F.col("kind") == "decision", probability(F.col("joint"))).otherwise(probability(F.col("mean")))
    return scored.select(*keys, "kind", F.round(p, 4).alias("p"), F.round("mean", 4).alias("mean_logprob"), F.round("least", 4).alias("min_logprob"), "tokens", "pivot", F.round(probability(F.col("least")), 4).alias("pivot_p"))


def score_items(fields: DataFrame, keys: list[str], core: list[str], field: str = "field", order: str = "field_ord") -> DataFrame:
    """Item scores: the least p of core fields, else of those that are not quotes; ties to the first field."""
    weakest = F.struct(F.col("p").alias("p"), F.col(order).alias("o"), F.col(field).alias("f"))
    is_core = F.col(field).isin(core)
    rows = fields.groupBy(*keys).agg(
        F.min(F.when(is_core, weakest)).alias("core"), F.min(F.when(F.col("kind") != "quote", weakest)).alias("any"),
        F.min(F.when(F.col("kind") == "decision", F.col("p"))).alias("decision"), F.min(F.when(F.col("kind") == "content", F.col("p"))).alias("content"),
        F.min(F.when(F.col("kind") == "quote", F.col("p"))).alias("quote_fidelity"),
        F.round(F.avg(F.when(~is_core & (F.col("kind") != "quote"), F.col("p"))), 4).alias("secondary_mean"),
        F.count_if(~is_core & (F.col("kind") != "quote") & (F.col("p") < MEDIUM)).alias("secondary_below_medium"),
    )
    chosen = F.coalesce("core", "any")
    return rows.select(*keys, chosen["p"].alias("score"), chosen["f"].alias("weakest_field"), "decision", "content", "quote_fidelity", "secondary_mean", "secondary_below_medium")


def claim_scores(edges: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Claims: the least of an edge's best score and its endpoints' best scores; null if the edge has none.

    edges(keys, id, subject, object, score), nodes(keys, id, score), a row for each observation.
    """
    best_nodes = nodes.groupBy(*keys, "id").agg(F.max("score").alias("score"))
    best_edges = edges.groupBy(*keys, "id", "subject", "object").agg(F.max("score").alias("own"))
    for role in ("subject", "object"):
        best_edges = best_edges.join(best_nodes.select(*keys, F.col("id").alias(role), F.col("score").alias(f"{role}_score")), [*keys, role], "left")
    claim = F.when(F.col("own").isNotNull(), F.least("own", "subject_score", "object_score"))
    parts = F.filter(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("s"), F.lit(n).alias("n"))) for c, n in (("own", "edge"), ("subject_score", "subject"), ("object_score", "object"))]), lambda x: x.isNotNull())
    limited = F.when(F.col("own").isNotNull(), F.array_min(parts)["n"])
    return best_edges.select(*keys, "id", "subject", "object", claim.alias("score"), F.col("own").alias("edge_score"), bucket(claim).alias("bucket"), limited.alias("limited_by"))


def bucket_counts(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of the four buckets with zeros."""
    return scored.groupBy(*keys).agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in ("high", "medium", "low", "unscored")])


def entropy(top: Column) -> Column:
    """Mean entropy in nats of arrays of alternatives' log-probabilities, what is left counting as one outcome."""
    one = lambda a: F.aggregate(F.transform(a, probability), F.lit(0.0), lambda s, p: s + F.when(p > 0, -p * F.log(p)).otherwise(0.0))
    rest = lambda a: F.greatest(F.lit(0.0), 1 - F.aggregate(F.transform(a, probability), F.lit(0.0), lambda s, p: s + p))
    value = F.transform(F.filter(top, lambda a: F.size(a) > 0), lambda a: one(a) + F.when(rest(a) > 0, -rest(a) * F.log(rest(a))).otherwise(0.0))
    return F.when(F.size(value) > 0, F.round(F.aggregate(value, F.lit(0.0), lambda s, v: s + v) / F.size(value), 4))


def perplexity(logprob: str) -> Column:
    """An aggregate: exp of the negative mean."""
    return F.round(F.exp(-F.avg(logprob)), 4)


def surprise_windows(tokens: DataFrame, keys: list[str], order: list[str], window: int = WINDOW) -> DataFrame:
    """(keys, start, finish, mean) of windows that begin at every half window; tokens beyond the last stay out."""
    by = Window.partitionBy(*keys)
    ordered = by.orderBy(*order)
    numbered = tokens.withColumn("i", F.row_number().over(ordered) - 1).withColumn("n", F.count("*").over(by))
    frame = ordered.rowsBetween(0, window - 1)
    rolled = numbered.withColumn("mean", F.avg("logprob").over(frame)).withColumn("finish", F.least(F.col("i") + window, F.col("n")))
    step = max(1, window // 2)
    return rolled.where((F.col("i") % step == 0) & (F.col("i") <= F.greatest(F.col("n") - window, F.lit(0)))).select(*keys, F.col("i").alias("start"), "finish", "mean")


def top_passages(windows: DataFrame, keys: list[str], kept: int = KEPT) -> DataFrame:
    """The most surprising windows that do not overlap one already chosen, by a fold over the sorted windows."""
    listed = windows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("mean", "start", "finish"))).alias("w"))
    kind = dict(windows.dtypes)
    start = F.array().cast(f"array<struct<mean:double,start:{kind['start']},finish:{kind['finish']}>>")
    free = lambda chosen, x: F.forall(chosen, lambda c: (x["finish"] <= c["start"]) | (x["start"] >= c["finish"]))
    chosen = F.aggregate("w", start, lambda a, x: F.when((F.size(a) < kept) & free(a, x), F.concat(a, F.array(x))).otherwise(a))
    return listed.select(*keys, F.posexplode(chosen).alias("place", "p")).select(*keys, (F.col("place") + 1).alias("rank"), "p.start", "p.finish", F.round(F.exp(-F.col("p.mean")), 2).alias("perplexity"))


def overlap_average(tokens: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, span_id, tokens, mean) of the tokens that overlap each span, both half-open, within the keys.

    The keys (a chunk or document) are an equi-join, so the range condition only meets tokens of the same text.
    """
    met = spans.join(tokens, keys).where("start < span_end and finish > span_start")
    return met.groupBy(*keys, "span_id").agg(F.count("*").alias("tokens"), F.avg("logprob").alias("mean"))
