"""Sections, sentences and offset-exact chunks of documents; spans of quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEADING = r"^(?:#+\s+|\s*%section\s+)(.+)$"
_SENTENCE = r"(?Us).+?(?:[.!?](?=\s|\z)|\z)"


def sections(docs: DataFrame, key: str = "doc_id", text: str = "text", default: str = "document") -> DataFrame:
    """(key, section_no, section, page, start_char, end_char, section_text): from each heading to the next.

    What stands before the first heading is a section of its own unless it is blank. `page N` sets the page.
    """
    lines = docs.where(F.col(text).isNotNull() & (F.col(text) != "")).select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    by = Window.partitionBy(key).orderBy("line_no")
    end = F.sum(F.length("line") + 1).over(by)
    lines = lines.withColumn("begin", end - F.length("line") - 1).withColumn("label", F.regexp_extract("line", HEADING, 1))
    lines = lines.withColumn("section_no", F.sum((F.col("label") != "").cast("int")).over(by))
    found = lines.groupBy(key, "section_no").agg(
        F.min("begin").cast("int").alias("start_char"), F.max(F.col("begin") + F.length("line")).cast("int").alias("last"), F.max(F.lower(F.trim("label"))).alias("label"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("section_text"),
    )
    nxt = F.lead("start_char").over(Window.partitionBy(key).orderBy("section_no"))
    found = found.withColumn("next", nxt).withColumn("section_text", F.when(F.col("next").isNotNull(), F.concat("section_text", F.lit("\n"))).otherwise(F.col("section_text")))
    page = F.regexp_extract("label", r"^page\s+(\d+)$", 1).try_cast("int")
    kept = found.where((F.col("section_no") > 0) | (F.trim("section_text") != ""))
    return kept.select(key, "section_no", F.when(F.col("label") == "", default).otherwise(F.col("label")).alias("section"), page.alias("page"), "start_char", F.coalesce("next", "last").alias("end_char"), "section_text")


def sentence_spans(text: Column) -> Column:
    """Half-open spans that tile a text, split behind sentence marks; blank ones are left out."""
    parts = F.regexp_extract_all(text, F.lit(_SENTENCE), 0)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    step = lambda a, x: F.struct(
        (a["at"] + F.length(x)).alias("at"),
        F.when(F.trim(F.regexp_replace(x, r"(?U)\s", "")) == "", a["spans"]).otherwise(F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), (a["at"] + F.length(x)).alias("end"))))).alias("spans"),
    )
    return F.aggregate(parts, start, step, lambda a: a["spans"])


def packed_spans(spans: Column, most_characters: int | None, most_sentences: int | None = None) -> Column:
    """Runs of sentences of at most so many characters and sentences; each holds one sentence at least."""
    start = F.array().cast("array<struct<start:int,end:int,n:int>>")

    def step(a, x):
        last = F.element_at(a, -1)
        fits = F.size(a) > 0
        if most_characters is not None:
            fits = fits & (x["end"] - last["start"] <= most_characters)
        if most_sentences is not None:
            fits = fits & (last["n"] < most_sentences)
        grown = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"), (last["n"] + 1).alias("n"))))
        fresh = F.concat(a, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(1).alias("n"))))
        return F.when(fits, grown).otherwise(fresh)

    return F.aggregate(spans, start, step)


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", most_characters: int | None = 4000, overlap: int = 400, most_sentences: int | None = None) -> DataFrame:
    """(key, chunk_no, section, page, text, start_char, end_char, token_count); text is exactly that span.

    Without limits a text is one chunk. Overlap reaches back inside the section and is not counted against the
    limit. Blank texts have no chunks.
    """
    usable = docs.where(F.col(text).isNotNull() & (F.trim(F.regexp_replace(text, r"(?U)\s", "")) != ""))
    if most_characters is None and most_sentences is None:
        whole = usable.select(key, F.lit(1).alias("chunk_no"), F.lit("document").alias("section"), F.lit(None).cast("int").alias("page"), F.col(text).alias("text"), F.lit(0).alias("start_char"), F.length(text).alias("end_char"))
        return whole.withColumn("token_count", F.greatest(F.lit(1), F.expr("length(text) div 4")))
    parts = sections(usable.select(key, text), key, text)
    runs = parts.select(key, "section_no", "section", "page", "start_char", "section_text", F.posexplode(packed_spans(sentence_spans(F.col("section_text")), most_characters, most_sentences)).alias("run_no", "run"))
    begin = F.when(F.col("run_no") > 0, F.greatest(F.col("run.start") - overlap, F.lit(0))).otherwise(F.col("run.start"))
    raw = F.substring(F.col("section_text"), F.col("begin") + 1, F.col("run.end") - F.col("begin"))
    cut = runs.withColumn("begin", begin).withColumn("raw", raw).withColumn("skip", F.length("raw") - F.length(F.regexp_replace("raw", r"(?U)^\s+", "")))
    cut = cut.withColumn("text", F.regexp_replace("raw", r"(?U)^\s+|\s+\z", ""))
    number = F.row_number().over(Window.partitionBy(key).orderBy("section_no", "run_no"))
    first = F.col("start_char") + F.col("begin") + F.col("skip")
    return cut.select(key, number.alias("chunk_no"), "section", "page", "text", first.alias("start_char"), (first + F.length("text")).alias("end_char"), F.greatest(F.lit(1), F.expr("length(text) div 4")).alias("token_count"))


def quote_spans(chunks_: DataFrame, quotes: DataFrame, key: str, text: str = "text", quote: str = "quote") -> DataFrame:
    """Quotes with the offsets of their first place in their chunk; null offsets where they do not stand there."""
    joined = quotes.join(chunks_, key, "left")
    at = F.position(F.col(quote), F.col(text))
    start = F.when((F.col(quote) != "") & (at > 0), F.coalesce(F.col("start_char"), F.lit(0)) + at - 1)
    return joined.withColumn("quote_start", start).withColumn("quote_end", start + F.length(quote))
