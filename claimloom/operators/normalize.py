"""Normalising extracted graphs: enum coercion, endpoint resolution, dangling references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spread import spread
from ..functions.text import fold

MIN_OVERLAP = 0.5


def coerce_enum(values: DataFrame, permitted: DataFrame, aliases: DataFrame | None = None, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """(value, coerced, how) for distinct values; permitted(name, ord), aliases(alias, name) with folded aliases.

    Tried in order: the value itself, equality after folding, a curated alias, the largest overlap of words of at
    least min_overlap, ties to the first permitted name. The permitted names of one enum are a small table.
    """
    distinct = values.select("value").where("value is not null").distinct()
    names = permitted.select("name", "ord", fold(F.col("name")).alias("folded"), F.array_distinct(F.split("name", "_")).alias("name_words"))
    folded = distinct.withColumn("text", F.trim("value")).withColumn("fold", fold(F.col("text")))
    exact = names.select(F.col("name").alias("text"), F.col("name").alias("by_text"))
    same = names.select(F.col("folded").alias("fold"), "name", "ord").groupBy("fold").agg(F.min_by("name", "ord").alias("by_fold"))
    out = folded.join(F.broadcast(exact), "text", "left").join(F.broadcast(same), "fold", "left")
    if aliases is None:
        out = out.withColumn("by_alias", F.lit(None).cast("string"))
    else:
        curated = aliases.join(names.select("name"), "name", "left_semi").select(F.col("alias").alias("fold"), F.col("name").alias("by_alias"))
        out = out.join(F.broadcast(curated), "fold", "left")
    words = out.where("by_text is null and by_fold is null and by_alias is null").select("value", F.array_distinct(F.split("fold", "_")).alias("words"))
    shared = words.select("value", "words", F.explode("words").alias("word")).join(F.broadcast(names.select("name", "ord", "name_words", F.explode("name_words").alias("word"))), "word")
    scored = shared.groupBy("value", "name", "ord", F.size("words").alias("n"), F.size("name_words").alias("m")).agg(F.count("*").alias("k"))
    scored = scored.withColumn("overlap", F.col("k") / (F.col("n") + F.col("m") - F.col("k"))).where(F.col("overlap") >= min_overlap)
    best = scored.withColumn("_rank", F.row_number().over(Window.partitionBy("value").orderBy(F.desc("overlap"), "ord"))).where("_rank = 1").select("value", F.col("name").alias("by_words"))
    out = out.join(best, "value", "left")
    how = F.when(F.col("by_text").isNotNull(), "exact").when(F.col("by_fold").isNotNull(), "case/punctuation").when(F.col("by_alias").isNotNull(), "curated alias").when(F.col("by_words").isNotNull(), "token overlap")
    return out.select("value", F.coalesce("by_text", "by_fold", "by_alias", "by_words").alias("coerced"), how.alias("how"))


def resolve_endpoints(edges: DataFrame, nodes: DataFrame, columns: list[str], slices: int | None = None) -> DataFrame:
    """Endpoints given by original id, new id or node name become new ids; what matches nothing stays.

    nodes: graph_ord, item_ord, raw_id, id, name. An original id wins over a new id, that over a name; of repeated
    original ids the last wins, of repeated names the first.
    Every way to name a node is a row of its own, so one aggregation over the nodes makes the lookup.
    Large tables meet in `slices` partitions.
    """
    way = lambda p, key: F.struct(F.lit(p).alias("p"), F.col(key).alias("key"))
    named = nodes.select("graph_ord", "item_ord", "id", F.explode(F.array(way(1, "raw_id"), way(2, "id"), way(3, "name"))).alias("_way"))
    named = named.select("graph_ord", "item_ord", "id", "_way.*").where("key is not null")
    of = lambda p, value: F.when(F.col("p") == p, F.col(value))
    found = spread(named, slices, "graph_ord", "key").groupBy("graph_ord", "key").agg(F.min("p").alias("_p"), F.max_by("id", of(1, "item_ord")).alias("_raw"), F.min_by("id", of(3, "item_ord")).alias("_name"))
    lookup = found.select("graph_ord", "key", F.when(F.col("_p") == 1, F.col("_raw")).when(F.col("_p") == 2, F.col("key")).otherwise(F.col("_name")).alias("_id"))
    for column in columns:
        one = lookup.withColumnRenamed("key", column)
        edges = spread(edges, slices, "graph_ord", column).join(one, ["graph_ord", column], "left").withColumn(column, F.coalesce("_id", column)).drop("_id")
    return edges


def drop_dangling(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges whose two endpoints are nodes of their graph, and those dropped."""
    known = nodes.select("graph_ord", F.col("id")).distinct()
    subject, target = known.withColumnRenamed("id", "subject"), known.withColumnRenamed("id", "object")
    kept = edges.join(subject, ["graph_ord", "subject"], "left_semi").join(target, ["graph_ord", "object"], "left_semi")
    no_subject = edges.join(subject, ["graph_ord", "subject"], "left_anti")
    no_object = edges.join(subject, ["graph_ord", "subject"], "left_semi").join(target, ["graph_ord", "object"], "left_anti")
    return kept, no_subject.unionByName(no_object)


def filter_references(df: DataFrame, column: str, known: str) -> DataFrame:
    """Keeps of an array of ids those in another array column of the row."""
    return df.withColumn(column, F.array_intersect(column, known))
