"""Bibliographic exports: RIS text to records, records to a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import build_slug, clean_text, local_path, parse_doi, parse_year
from ..operators.merge import unique_slugs

#: A tag line and the tags of each field in order of preference (fixed values).
LINE = r"^([A-Z][A-Z0-9])\s{0,2}-\s?(.*)$"
TITLE, JOURNAL, AUTHOR, FILES, YEARS = ["TI", "T1", "CT", "BT"], ["T2", "JO", "JF", "JA", "J2"], ["AU", "A1", "A2", "A3", "A4"], ["L1", "L2", "L4", "LK"], ["PY", "Y1", "DA"]


def records(texts: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, record_no, tags map<string, array<string>>) of RIS texts.

    TY begins a record and ER ends it; a line without a tag continues the one before with one space; blank lines
    are skipped; a last record without ER is kept.
    """
    lines = texts.select(file, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line")).where(F.trim("line") != "")
    by = Window.partitionBy(file).orderBy("line_no")
    tagged = lines.withColumn("tag", F.nullif(F.regexp_extract("line", LINE, 1), F.lit(""))).withColumn("value", F.when(F.col("tag").isNotNull(), F.trim(F.regexp_extract("line", LINE, 2))).otherwise(F.trim("line")))
    tagged = tagged.withColumn("record_no", F.sum((F.col("tag") == "TY").cast("int")).over(by)).withColumn("field_no", F.count("tag").over(by))
    ended = F.max((F.col("tag") == "ER").cast("int")).over(Window.partitionBy(file, "record_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
    inside = tagged.withColumn("ended", F.coalesce(ended, F.lit(0))).where("record_no > 0 and ended = 0")
    fields = inside.groupBy(file, "record_no", "field_no").agg(F.max("tag").alias("tag"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"]), " ").alias("value"))
    values = fields.groupBy(file, "record_no", "tag").agg(F.transform(F.array_sort(F.collect_list(F.struct("field_no", "value"))), lambda x: x["value"]).alias("values"))
    return values.groupBy(file, "record_no").agg(F.map_from_entries(F.collect_list(F.struct("tag", "values"))).alias("tags"))


def first_of(tags: Column, names: list[str]) -> Column:
    """The first non-blank first value among these tags."""
    return F.coalesce(*[F.nullif(F.trim(F.try_element_at(F.try_element_at(tags, F.lit(n)), F.lit(1))), F.lit("")) for n in names])


def _all(tags: Column, names: list[str]) -> Column:
    return F.flatten(F.array(*[F.coalesce(F.try_element_at(tags, F.lit(n)), F.array().cast("array<string>")) for n in names]))


def manifest(found: DataFrame, order: list[str]) -> DataFrame:
    """Document rows of records: slug, document_id, doi, title, authors, year, journal, pages, abstract, keywords, links."""
    t = F.col("tags")
    years = F.filter(F.transform(_all(t, YEARS), parse_year), lambda x: x.isNotNull())
    dois = F.filter(F.transform(_all(t, ["DO", "M3", "UR", "N1"]), parse_doi), lambda x: x.isNotNull())
    rows = found.select(
        "*", clean_text(first_of(t, TITLE)).alias("title"), _all(t, AUTHOR).alias("authors"), F.get(years, 0).alias("year"), F.get(dois, 0).alias("doi"),
        clean_text(first_of(t, JOURNAL)).alias("journal"), first_of(t, ["TY"]).alias("publication_type"), first_of(t, ["VL"]).alias("volume"), first_of(t, ["IS"]).alias("issue"),
        F.nullif(F.concat_ws("-", first_of(t, ["SP"]), first_of(t, ["EP"])), F.lit("")).alias("pages"), first_of(t, ["AB", "N2"]).alias("abstract"), _all(t, ["KW"]).alias("keywords"),
        F.filter(F.transform(_all(t, FILES), local_path), lambda x: x.isNotNull()).alias("links"),
    ).drop("tags")
    rows = rows.withColumn("slug", build_slug(F.get("authors", 0), F.col("year"), F.col("title")))
    rows = unique_slugs(rows, "slug", order)
    return rows.withColumn("document_id", F.coalesce("doi", F.concat(F.lit("doc:"), "slug")))


def read_ris(spark: SparkSession, folder: str) -> DataFrame:
    """Records of every .ris file below a folder, shallow files first."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{ris,RIS}").load(folder)
    texts = files.select(F.col("path").alias("file"), F.decode("content", "UTF-8").alias("text"), F.size(F.split("path", "/")).alias("depth"))
    return records(texts).join(texts.select("file", "depth"), "file")
