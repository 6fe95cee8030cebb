"""Referential integrity and schema checks as tables of problems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _problems(df: DataFrame, rule: str, id_: Column, message: Column) -> DataFrame:
    return df.select("graph_ord", F.lit(rule).alias("rule"), id_.cast("string").alias("id"), message.alias("message"))


def check_integrity(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(graph_ord, rule, id, message) for ids that are missing, repeated or unknown; nodes(id), edges(id, subject, object)."""
    out = _problems(nodes.where("id is null or id = ''"), "missing_node_id", F.lit(None), F.lit("node without id"))
    for df, kind in ((nodes, "node"), (edges, "edge")):
        repeated = df.where("id is not null").groupBy("graph_ord", "id").agg(F.count("*").alias("n")).where("n > 1")
        out = out.unionByName(_problems(repeated, f"duplicate_{kind}_id", F.col("id"), F.concat(F.lit(f"duplicate {kind} id "), "id")))
    known = nodes.select("graph_ord", "id").distinct()
    for role in ("subject", "object"):
        out = out.unionByName(_problems(edges.where(F.col(role).isNull()), f"missing_{role}", F.col("id"), F.lit(f"edge has no {role}")))
        lost = edges.where(F.col(role).isNotNull()).join(known.withColumnRenamed("id", role), ["graph_ord", role], "left_anti")
        out = out.unionByName(_problems(lost, f"unknown_{role}", F.col("id"), F.concat(F.lit(f"unknown {role} "), F.col(role))))
    return out


def check_rules(df: DataFrame, rules: dict[str, Column], id_: str = "id") -> DataFrame:
    """A row for each rule that a row breaks: one scan, whatever the number of rules."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return df.select("graph_ord", F.col(id_).cast("string").alias("id"), F.explode(broken).alias("rule"))


def required(column: str) -> Column:
    return F.col(column).isNotNull()


def one_of(column: str, values: list[str]) -> Column:
    return F.col(column).isNull() | F.col(column).isin(values)


def between(column: str, low: float, high: float) -> Column:
    return F.col(column).isNull() | F.col(column).between(low, high)


def matches(column: str, pattern: str) -> Column:
    return F.col(column).isNull() | F.col(column).rlike(pattern)
