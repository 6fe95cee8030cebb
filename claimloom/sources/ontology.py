"""Ontologies: classes and individuals of RDF/XML files as a table of terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TEXTS = "array<string>"
#: Synonym elements and prefixes that are left out (fixed values).
SYNONYMS = ["oboInOwl:hasExactSynonym", "oboInOwl:hasNarrowSynonym", "oboInOwl:hasRelatedSynonym", "oboInOwl:hasBroadSynonym", "skos:altLabel", "skos:prefLabel"]
EXCLUDED = ["orcid", "doi", "foaf", "dcterms", "dce"]


def read_classes(spark: SparkSession, path: str, tags: tuple[str, ...] = ("owl:Class", "owl:NamedIndividual")) -> DataFrame:
    """(iri, labels, synonyms) of elements with an IRI."""
    value = "array<struct<_VALUE:string,`_xml:lang`:string>>"
    schema = ", ".join(["`_rdf:about` string", f"`rdfs:label` {value}", *[f"`{s}` {value}" for s in SYNONYMS]])
    out = None
    for tag in tags:
        rows = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
        texts = lambda c: F.coalesce(F.transform(f"`{c}`", lambda x: x["_VALUE"]), F.array().cast(_TEXTS))
        one = rows.where("`_rdf:about` is not null").select(F.col("`_rdf:about`").alias("iri"), texts("rdfs:label").alias("labels"), F.flatten(F.array(*[texts(s) for s in SYNONYMS])).alias("synonyms"))
        out = one if out is None else out.unionByName(one)
    return out


def terms(classes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(curie, label, synonyms): the longest prefix base names an IRI, else its last segment does.

    The first label names a term, others are synonyms; terms without a label and excluded prefixes are left out.
    Elements that repeat an IRI are taken in the order of their labels. prefixes(prefix, base) is a small table.
    """
    joined = classes.join(F.broadcast(prefixes), F.expr("startswith(iri, base)"), "left")
    best = joined.groupBy("iri").agg(F.max_by(F.concat("prefix", F.lit(":"), F.expr("substring(iri, length(base) + 1)")), F.length("base")).alias("known"), F.flatten(F.array_sort(F.collect_set("labels"))).alias("labels"), F.flatten(F.array_sort(F.collect_set("synonyms"))).alias("synonyms"))
    tail = F.element_at(F.split("iri", "[/#]"), -1)
    curie = F.coalesce("known", F.regexp_replace(tail, "^([A-Za-z]+)_", "$1:"))
    rows = best.select(curie.alias("curie"), F.get("labels", 0).alias("label"), F.array_distinct(F.concat(F.slice("labels", 2, 1000), "synonyms")).alias("synonyms"))
    return rows.where(F.col("label").isNotNull() & ~F.substring_index("curie", ":", 1).isin(EXCLUDED))
