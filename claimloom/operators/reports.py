"""Rankings, labels and totals for reports.

Ranks within a document are windows over that document's rows; rankings of a whole corpus are range sorts on explicit
rank columns, never one window over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .confidence import probability

#: Order of statuses and of confidence buckets in the corpus ranking (fixed values).
STATUS_ORDER = {"conflict": 0, "unsupported": 1, "partial": 2}
CONFIDENCE_ORDER = {"low": 0, "medium": 1, "high": 2}
LAST = 3


def flagged(status: Column) -> Column:
    """Whether an item's agreement status asks for a review."""
    return ~status.isin("agreed", "unchecked")


def quote_found(spans: Column) -> Column:
    """Whether an item has spans and all of them were found in the text; null spans give false."""
    return F.coalesce((F.size(spans) > 0) & F.forall(spans, lambda s: s["start_char"].isNotNull()), F.lit(False))


def edge_labels(edges: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """Edges with a `label` such as `A --NOT causes--> B`; an endpoint without a name shows its id.

    names(keys, id, name) has one row for each id. Null names, empty names and unknown ids fall back to the id.
    """
    found = edges
    for end in ("subject", "object"):
        of = names.select(*keys, F.col("id").alias(end), F.nullif("name", F.lit("")).alias(f"_{end}"))
        found = found.join(of, [*keys, end], "left")
    verb = F.concat(F.when(F.col("negated"), "NOT ").otherwise(""), "predicate")
    label = F.concat(F.coalesce("_subject", "subject"), F.lit(" --"), verb, F.lit("--> "), F.coalesce("_object", "object"))
    return found.withColumn("label", label).drop("_subject", "_object")


def ranked_omissions(omissions: DataFrame, keys: list[str]) -> DataFrame:
    """omissions(keys, witnesses, endpoints_in_primary, label) with a `rank` within their document.

    Most witnesses first, then those whose endpoints the primary graph has, then by label.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc(F.size("witnesses")), F.desc("endpoints_in_primary"), "label")
    return omissions.withColumn("rank", F.row_number().over(order))


def _place(column: str, order: dict[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.coalesce(column, F.lit(""))), F.lit(LAST))


def ranked_disputes(items: DataFrame, ties: list[str] | None = None) -> DataFrame:
    """The flagged rows of items(status, confidence), the gravest status first, then the least confident.

    `status_place` and `confidence_place` are the sort keys; unknown and null values come last. The few pairs of places
    are too few ranges for many tasks; columns named in `ties` order equal rows and let ranges end within a pair.
    """
    places = {"status_place": _place("status", STATUS_ORDER), "confidence_place": _place("confidence", CONFIDENCE_ORDER)}
    return items.where(flagged(F.col("status"))).withColumns(places).orderBy("status_place", "confidence_place", *(ties or []))


def merged_sources(entries: DataFrame, id_map: DataFrame) -> DataFrame:
    """Sidecar entries(graph_ord, old_id, ...) with the `id` of their merged item; one without a new id keeps its own."""
    found = entries.join(id_map.select("graph_ord", "old_id", "new_id"), ["graph_ord", "old_id"], "left")
    return found.withColumn("id", F.coalesce("new_id", "old_id")).drop("new_id")


def merged_index(sources: DataFrame) -> DataFrame:
    """(id, sources, best, flagged) of each merged item; the sources themselves stay rows of `merged_sources`."""
    return sources.groupBy("id").agg(F.count("*").alias("sources"), F.max("score").alias("best"), F.coalesce(F.bool_or("flagged"), F.lit(False)).alias("flagged"))


def snapshot_union(column: str) -> Column:
    """Aggregate: the distinct snapshot names, sorted and joined; null if there are none."""
    names = F.array_sort(F.collect_set(F.nullif(F.col(column), F.lit(""))))
    return F.when(F.size(names) > 0, F.array_join(names, "; "))


def manifest_counts(manifest: DataFrame) -> DataFrame:
    """One row with the counts of manifest(pdf_path, match)."""
    return manifest.agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("pdf_path") != "").alias("with_pdf"),
        F.count_if(F.col("match") == "unmatched_pdf").alias("unmatched_pdfs"),
        F.count_if(F.col("match") == "no_pdf").alias("missing_pdfs"),
    )


def usage_totals(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Mean perplexity of the answers and the sum of reasoning tokens of chunks(answer_perplexity, perplexity, reasoning_tokens).

    A missing or zero answer perplexity gives way to that of the whole output; means are rounded to four places.
    """
    answer = F.coalesce(F.nullif("answer_perplexity", F.lit(0.0)), "perplexity")
    return chunks.groupBy(*keys).agg(F.round(F.avg(answer), 4).alias("output_perplexity"), F.sum(F.coalesce("reasoning_tokens", F.lit(0))).alias("reasoning_tokens"))


def alternatives(top: Column, most: int = 5) -> Column:
    """The first alternatives of a token, array<struct<token, logprob>>, as array<struct<token, p>>."""
    return F.transform(F.slice(top, 1, most), lambda x: F.struct(x["token"].alias("token"), F.round(probability(x["logprob"]), 4).alias("p")))


def tally(rows: DataFrame, column: str) -> DataFrame:
    """Counts of a column's values with their place in print order: the most first, ties by value.

    The window runs over one row for each value of a status column, not over the table.
    """
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), column)))
