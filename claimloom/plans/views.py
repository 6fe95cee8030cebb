"""Views of the driver tables in the shapes of the engine's own tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.spread import spread

#: Bytes of the line table's files that one partition of the views takes.
SLICE = 4 << 20
#: Bytes up to which Spark itself chooses the join with the parts.
SMALL = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MENTIONS = """
select l_orderkey as graph_ord,
       cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as int) as item_ord,
       p_name as entity_term, lower(p_type) as measured_attribute,
       case l_returnflag when 'R' then 'decreased' when 'A' then 'increased' else 'unchanged' end as qualifier,
       case p_size % 4 when 0 then 'environmental_variable' when 1 then 'environmental_process'
            when 2 then 'management_intervention' else 'taxon' end as entity_type,
       p_brand as name, l_linestatus, l_discount, l_tax, l_suppkey, l_partkey
from {lineitem} join {part} on l_partkey = p_partkey"""

_CLAIMS = """
select graph_ord, item_ord, subject_ord, object_ord,
       case l_linestatus when 'O' then 'causes' else 'prevents' end as predicate, l_discount > 0.08 as negated,
       case when l_tax < 0.02 then 'no_relationship' when l_tax < 0.04 then 'associational'
            when l_tax < 0.06 then 'uncertain_causal' else 'direct_causal' end as claim_strength,
       concat('ord:', cast(graph_ord as {text})) as source_document, l_suppkey
from (select *, item_ord as subject_ord, lead(item_ord) over (partition by graph_ord order by item_ord) as object_ord from {mentions}) m
where object_ord is not null"""


def mentions_sql() -> str:
    """The mention view as SQL over the driver's table names."""
    return _MENTIONS.format(lineitem="lineitem", part="part")


def claims_sql() -> str:
    return _CLAIMS.format(mentions=f"({mentions_sql()}) mm", text="varchar")


def _size(df: DataFrame) -> int:
    """Bytes that Spark's statistics give a table: those of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def slices(spark: SparkSession, sf_dir: str) -> int | None:
    """How many partitions the views take: none of their own for small tables, for larger ones as many as they grow (`SLICE`)."""
    found = math.ceil(_size(table(spark, sf_dir, "lineitem")) / SLICE)
    return found if found > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _lines(spark: SparkSession, sf_dir: str, *computed: Column) -> DataFrame:
    """Order lines with their parts, those of one order in one partition, and columns computed before lines move there."""
    line, part, count = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), slices(spark, sf_dir)
    if count and _size(part) > SMALL:
        line, part = spread(line, count, "l_partkey"), spread(part, count, "p_partkey").hint("merge")
    joined = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("*", *computed)
    return spread(joined, count, "l_orderkey")


def _order() -> WindowSpec:
    """The order of a graph's lines, as in the SQL."""
    return Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes: one row for each order line, in order within its graph."""
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("graph_ord"), F.row_number().over(_order()).alias("item_ord"), *[c.alias(name) for name, c in facets().items()],
        F.col("p_brand").alias("name"), "l_linestatus", "l_discount", "l_tax", "l_suppkey", "l_partkey",
    ).withColumn("node", F.concat_ws(":", F.lit("n"), "graph_ord", "item_ord"))


def claims(spark: SparkSession, sf_dir: str, nodes: DataFrame | None = None) -> DataFrame:
    """Edges: consecutive mentions of one order. Without `nodes` they come from the lines with a single window."""
    name = lambda c: F.concat_ws(":", F.lit("n"), "graph_ord", c)
    if nodes is not None:
        found = spark.sql(_CLAIMS.format(mentions="{m}", text="string"), m=nodes)
    else:
        tax, graph = F.col("l_tax"), F.col("graph_ord")
        more = F.lead(F.lit(True)).over(_order())
        rows = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("graph_ord"), F.row_number().over(_order()).alias("item_ord"), more.alias("_more"), "l_linestatus", "l_discount", "l_tax", "l_suppkey").where("_more")
        found = rows.select(
            "graph_ord", "item_ord", F.col("item_ord").alias("subject_ord"), (F.col("item_ord") + 1).alias("object_ord"),
            F.when(F.col("l_linestatus") == "O", "causes").otherwise("prevents").alias("predicate"), (F.col("l_discount") > 0.08).alias("negated"),
            F.when(tax < 0.02, "no_relationship").when(tax < 0.04, "associational").when(tax < 0.06, "uncertain_causal").otherwise("direct_causal").alias("claim_strength"),
            F.concat(F.lit("ord:"), graph.cast("string")).alias("source_document"), "l_suppkey",
        )
    return found.withColumn("subject", name("subject_ord")).withColumn("object", name("object_ord"))


def consecutive(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    """(graph_ord, l_linestatus, subject, object): the keys of consecutive mentions, a function of `facets` of the lines."""
    lines = _lines(spark, sf_dir, key.alias("_key"))
    return lines.select(F.col("l_orderkey").alias("graph_ord"), "l_linestatus", F.col("_key").alias("subject"), F.lead("_key").over(_order()).alias("object")).where("object is not null")


def facets() -> dict[str, Column]:
    """The identity's fields of a mention from a line and its part."""
    flag, kind = F.col("l_returnflag"), F.col("p_size") % 4
    return {
        "entity_term": F.col("p_name"),
        "measured_attribute": F.lower("p_type"),
        "qualifier": F.when(flag == "R", "decreased").when(flag == "A", "increased").otherwise("unchanged"),
        "entity_type": F.when(kind == 0, "environmental_variable").when(kind == 1, "environmental_process").when(kind == 2, "management_intervention").otherwise("taxon"),
    }
