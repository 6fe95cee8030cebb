"""Identities and ids of nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import norm

DIGITS = 12
NODE_PREFIX, EDGE_PREFIX, GRAPH_PREFIX = "camo:node_", "camo:edge_", "camo:graph_"


def stable_id(prefix: str, *parts: Column) -> Column:
    """The prefix and the first hex digits of a sha256 over the parts; null parts are empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, DIGITS))


def node_key(term: Column, attribute: Column, qualifier: Column, kind: Column, applied_to: Column | None = None) -> Column:
    """The folded identity of a node as one string; applied_to terms are folded and sorted."""
    extra = F.lit("") if applied_to is None else F.array_join(F.array_sort(F.transform(applied_to, norm)), "\x1f")
    return F.concat_ws("|", norm(term), norm(attribute), norm(qualifier), norm(kind), extra)


def node_id(*facets: Column) -> Column:
    return F.concat(F.lit(NODE_PREFIX), F.substring(F.sha2(node_key(*facets), 256), 1, DIGITS))


def node_number(*facets: Column) -> Column:
    """The digits of `node_id` as a number: what joins and aggregations should carry instead of the text."""
    return F.conv(F.substring(F.sha2(node_key(*facets), 256), 1, DIGITS), 16, 10).cast("bigint")


def node_text(number: Column) -> Column:
    """The `node_id` of a `node_number`."""
    return F.concat(F.lit(NODE_PREFIX), F.lpad(F.lower(F.hex(number)), DIGITS, "0"))


def edge_id(subject: Column, predicate: Column, target: Column, sentence: Column, document: Column) -> Column:
    return stable_id(EDGE_PREFIX, subject, predicate, target, sentence, document)
