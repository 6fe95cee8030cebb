"""N-gram Jaccard self-join by grouped prefixes: near-duplicate documents and their components.

Documents are sets of 5-word shingle hashes in one global order: shingles that are frequent within input tasks
come last (a bounded list of the most frequent ones is broadcast; which shingles are in it changes the order,
never a result), the others by hash. Two sets with Jaccard similarity of at least t share a shingle among their
first n - ceil(t n) + 1. Documents with identical sets collapse into one, those with an identical prefix and
size into one group. Groups that share a prefix shingle and pass the size and position filters are candidates,
expanded to members, whose whole texts are compared exactly.

Copies need no pairs: a first round compares every group with one leader for each shared shingle and merges
what links. The leader is the group in whose order the shingle comes earliest: edits put rare shingles first, so
this is the least edited of a family, the one that links with most. A second round compares the remaining candidates whose components still differ, all of them, so
that no link between components is lost. Of the shingles that the very same groups share, such as those of one
passage, only the first in the order is joined there: two sets that link pass every filter at their first common
shingle, and no shingle of the same groups can come before it.

Defined results: a null or empty text has no shingles and is a component of its own. Rows that repeat a doc_id
are one document, linked if any of its rows links; each row is returned. Rows with a null doc_id are returned
with a null component. An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .components import connected_components
from .staging import staged

SHINGLE_WORDS = 5
#: The similarity bound as a fraction.
SIMILARITY = (75, 100)
#: Size bound of the broadcast list of frequent shingles, nine bytes each.
FREQUENT_SHINGLES = 500_000
_LOCAL_MINIMUM = 2
#: Shingles that a task holds while it counts.
_HELD_SHINGLES = 3_000_000
#: Signatures that a task remembers of what it has met, eight bytes each.
_MET_SIGNATURES = 500_000
#: Prefix entries that meet in one part; there are as many parts as the data need.
PART_ENTRIES = 1_000_000
_BODY = np.uint64((1 << 56) - 1)


class Threshold:
    """Exact integer bounds for similarity num / den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den

    def probe(self, n):
        """Prefix length that meets every partner at least as large as the bound allows."""
        return n - (self.num * n + self.den - 1) // self.den + 1

    def linked(self, common: int, union: int) -> bool:
        return self.den * common >= self.num * union


class Order:
    """The global order: shingle hashes become keys whose top byte is a frequency level."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        at = np.argsort(tokens)
        self.tokens = tokens[at]
        self.levels = np.minimum(255, np.floor(8 * np.log2(np.maximum(counts[at], 2)))).astype(np.uint64)

    def keys(self, shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        found = shingles & _BODY
        if len(self.tokens) and len(shingles):
            at = np.minimum(np.searchsorted(self.tokens, shingles), len(self.tokens) - 1)
            hit = self.tokens[at] == shingles
            if hit.any():
                found[hit] |= self.levels[at[hit]] << np.uint64(56)
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            found[begin:end].sort()
        return found


class _Met:
    """Which signatures a task has met before, among at least the latest half of `_MET_SIGNATURES`."""

    def __init__(self) -> None:
        self.known, self.latest, self.pending = (np.zeros(0, np.uint64) for _ in range(3))

    def new(self, signatures: np.ndarray) -> np.ndarray:
        """Marks the first row of each signature not met yet."""
        keep = np.zeros(len(signatures), dtype=bool)
        fresh, first = np.unique(signatures, return_index=True)
        seen = np.zeros(len(fresh), dtype=bool)
        for table in (self.known, self.latest, self.pending):
            if len(table):
                seen |= table[np.minimum(np.searchsorted(table, fresh), len(table) - 1)] == fresh
        keep[first[~seen]] = True
        self.pending = np.union1d(self.pending, fresh[~seen])
        if len(self.pending) > _MET_SIGNATURES // 64:
            self.latest, self.pending = np.union1d(self.latest, self.pending), self.pending[:0]
        if len(self.latest) > _MET_SIGNATURES // 2:
            self.known, self.latest = self.latest, self.latest[:0]
        return keep


def _add_up(tokens: list[np.ndarray], counts: list[np.ndarray], latest: int = 0) -> None:
    """Replaces the latest arrays (all for 0) by one of distinct tokens and one of their counts, freeing each array once read."""
    token, count = np.concatenate(tokens[-latest:]), np.concatenate(counts[-latest:])
    del tokens[-latest:], counts[-latest:]
    at = np.argsort(token)
    count = count[at]
    token = token[at]
    del at
    first = np.flatnonzero(np.append(token[:1] == token[:1], token[1:] != token[:-1]))
    tokens.append(token[first])
    counts.append(np.add.reduceat(count, first, dtype=np.uint32) if len(first) else count)


def frequent_shingles(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = FREQUENT_SHINGLES) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several documents of one input task hold most often: at most `most`, with counts."""

    def count(batches):
        tokens, counts, size, met = [], [], 0, _Met()

        def out():
            token, n = tokens.pop(), counts.pop()
            often = n >= _LOCAL_MINIMUM
            return pa.RecordBatch.from_arrays([pa.array(token[often].view(np.int64)), pa.array(n[often], pa.int64())], ["token", "n"])

        for batch in batches:
            for _, _, data, offsets in tk.text_slices(batch.column(0)):
                shingles, bounds = tk.shingle_sets(data, offsets, words)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(shingles))])
                keep = met.new(sums[bounds[1:]] - sums[bounds[:-1]])
                fresh = shingles[np.repeat(keep, np.diff(bounds))]
                tokens.append(fresh)
                counts.append(np.ones(len(fresh), np.uint32))
                _add_up(tokens, counts, 1)
                size += len(tokens[-1])
                if size > _HELD_SHINGLES:
                    _add_up(tokens, counts)
                    size = len(tokens[0])
                    if size > _HELD_SHINGLES // 2:
                        yield out()
                        size = 0
        if tokens:
            _add_up(tokens, counts)
            yield out()

    counted = staged(docs.select("text").mapInArrow(tk.tidy(count), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    sizes = counted.groupBy(F.least("n", F.lit(4096)).alias("n")).count().collect()
    at_least, total = 4097, 0
    for row in sorted(sizes, key=lambda r: -r["n"]):
        total += row["count"]
        if total > most:
            break
        at_least = row["n"]
    chosen = counted.where(F.col("n") >= at_least).toArrow()
    return chosen.column("token").to_numpy().view(np.uint64), chosen.column("n").to_numpy()


def _signatures(keys: np.ndarray, bounds: np.ndarray, lengths: np.ndarray, salt: int) -> np.ndarray:
    """A hash of the first `lengths` keys of each row together with the row's size."""
    sums = np.zeros(len(keys) + 1, dtype=np.uint64)
    np.cumsum(tk.mix(keys + np.uint64(salt)), out=sums[1:])
    return tk.mix(sums[bounds[:-1] + lengths] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def document_sets(docs: DataFrame, order, words: int, threshold: Threshold) -> DataFrame:
    """(doc_id, n, set1, set2, prefix) of every row: its set's size and hashes."""

    def rows(batches):
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for _, _, data, offsets in tk.text_slices(batch.column("text")):
                shingles, bounds = tk.shingle_sets(data, offsets, words)
                keys = order.value.keys(shingles, bounds)
                n = np.diff(bounds)
                prefix = np.where(n > 0, threshold.probe(n), 0)
                for x, values in zip(out, (n, _signatures(keys, bounds, n, 1), _signatures(keys, bounds, n, 2), _signatures(keys, bounds, prefix, 3)), strict=True):
                    x.append(values.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64())] + [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in out], ["doc_id", "n", "set1", "set2", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(tk.tidy(rows), "doc_id bigint, n bigint, set1 bigint, set2 bigint, prefix bigint")


def _packed(values: np.ndarray) -> tuple[bytes, int]:
    kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    return values.astype(kind).tobytes(), kind.itemsize


def shared_prefixes(docs: DataFrame, order, words: int, threshold: Threshold, parts: int) -> DataFrame:
    """(token, prefix, size, pos) of every prefix shingle that two groups or more have.

    A task emits a group once, however many copies it reads. Entries travel packed by hash part. A frequent shingle's entries go to parts by group as well and are all
    returned; other shingles meet in one part, where those of one group only are dropped.
    """

    def emit(batches):
        held, size, met = [], 0, _Met()

        def out():
            token, group, n, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            frequent = token > _BODY
            part = tk.mix(np.where(frequent, token ^ group, token)) % np.uint64(parts)
            at = np.argsort(part.astype(np.uint16 if parts <= 65536 else np.uint64), kind="stable")
            token, group, n, pos, part = (x[at] for x in (token, group, n, pos, part))
            edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist() + [len(part)]
            blobs, widths = [], []
            for b, e in zip(edges[:-1], edges[1:], strict=True):
                (size_bytes, w1), (pos_bytes, w2) = _packed(n[b:e]), _packed(pos[b:e])
                blobs.append(token[b:e].tobytes() + group[b:e].tobytes() + size_bytes + pos_bytes)
                widths.append(w1 * 16 + w2)
            return pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]].astype(np.int32)), pa.array(widths, pa.int32()), pa.array(blobs, pa.binary())], ["part", "widths", "entries"])

        for batch in batches:
            for _, _, data, offsets in tk.text_slices(batch.column(0)):
                shingles, bounds = tk.shingle_sets(data, offsets, words)
                if not len(shingles):
                    continue
                keys = order.value.keys(shingles, bounds)
                n = np.diff(bounds)
                prefix = np.where(n > 0, threshold.probe(n), 0)
                group = _signatures(keys, bounds, prefix, 3)
                prefix = np.where(met.new(group), prefix, 0)
                pos = np.arange(prefix.sum()) - np.repeat(np.cumsum(prefix) - prefix, prefix)
                held.append((keys[np.repeat(bounds[:-1], prefix) + pos], np.repeat(group, prefix), np.repeat(n, prefix), pos))
                size += len(pos)
                if size > 1_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def meet(table: pa.Table) -> pa.Table:
        columns = [[], [], [], []]
        for widths, blob in zip(table.column("widths").to_pylist(), table.column("entries"), strict=True):
            data = blob.as_buffer()
            w1, w2 = divmod(widths, 16)
            count, at = len(data) // (16 + w1 + w2), 0
            for x, w in zip(columns, (8, 8, w1, w2), strict=True):
                x.append(np.frombuffer(data, f"u{w}", count, at))
                at += w * count
        token, group, n, pos = (np.concatenate(x) for x in columns)
        at = np.lexsort((group, token))
        token, group, n, pos = token[at], group[at], n[at], pos[at]
        new = np.append(True, (token[1:] != token[:-1]) | (group[1:] != group[:-1]))
        token, group, n, pos = token[new], group[new], n[new], pos[new]
        same = np.append(False, token[1:] == token[:-1])
        keep = same | np.append(same[1:], False) | (token > _BODY)
        return pa.table({"token": token[keep].view(np.int64), "prefix": group[keep].view(np.int64), "size": n[keep].astype(np.int32), "pos": pos[keep].astype(np.int32)})

    packed = docs.select("text").mapInArrow(tk.tidy(emit), "part int, widths int, entries binary")
    return packed.groupBy("part").applyInArrow(meet, "token bigint, prefix bigint, size int, pos int")


def _passes(a: str, b: str, t: Threshold):
    """The size filter, the prefix lengths for these two sizes, and bounds on what can be common.

    Before a shared shingle only those shingles can be common that some other prefix has too (`place` of them): a
    common shingle before it stands in both prefixes. From it on, at most what the shorter rest holds is common.
    Likewise up to the earlier of the two prefix ends (`shared`), and behind it what that side has left.
    """
    c = lambda side, name: F.col(f"{side}.{name}").cast("bigint")
    small, large = F.least(c(a, "size"), c(b, "size")), F.greatest(c(a, "size"), c(b, "size"))
    needed = F.ceil((t.num * (small + large)) / (t.num + t.den))
    within = (c(a, "pos") <= c(a, "size") - needed) & (c(b, "pos") <= c(b, "size") - needed)
    most = F.least(c(a, "place"), c(b, "place")) + F.least(c(a, "size") - c(a, "pos"), c(b, "size") - c(b, "pos"))
    behind = lambda side: F.floor((t.num * c(side, "size") + t.den - 1) / t.den) - 1
    met = F.least(c(a, "shared"), c(b, "shared")) + F.greatest(behind(a), behind(b))
    return (t.den * small >= t.num * large) & within & (F.least(most, met) * (t.num + t.den) >= t.num * (small + large))


def verified(docs: DataFrame, pairs: DataFrame, words: int, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose whole texts reach the similarity bound."""

    def compare(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            row = 0
            left = _sets(batch.column("text_a"), words)
            right = _sets(batch.column("text_b"), words)
            for x, y in zip(left, right, strict=True):
                if len(x) and len(y):
                    common = int(np.count_nonzero(x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y))
                    keep[row] = threshold.linked(common, len(x) + len(y) - common)
                row += 1
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    text = docs.select("doc_id", "text")
    joined = pairs.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(tk.tidy(compare), "a bigint, b bigint")


def _sets(column: pa.Array, words: int):
    for _, n, data, offsets in tk.text_slices(column):
        shingles, bounds = tk.shingle_sets(data, offsets, words)
        for i in range(n):
            yield shingles[bounds[i] : bounds[i + 1]]


def _both(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def jaccard_components(docs: DataFrame, words: int = SHINGLE_WORDS, similarity: tuple[int, int] = SIMILARITY, frequent: int = FREQUENT_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    threshold = Threshold(*similarity)
    order = spark.sparkContext.broadcast(Order(*frequent_shingles(docs, words, frequent)))
    sets = staged(document_sets(docs, order, words, threshold), "sets")
    named = sets.where("n > 0 and doc_id is not null")
    classes = staged(named.groupBy("set1", "set2", "n").agg(F.min("doc_id").alias("rep"), F.min("prefix").alias("prefix")), "classes")
    members = classes.select("prefix", F.col("rep").alias("doc"))
    leads = members.groupBy("prefix").agg(F.min("doc").alias("lead"))
    prefixes = F.col("n") - F.ceil((threshold.num * F.col("n")) / threshold.den) + 1
    parts = max(1, -(-int(classes.groupBy("prefix").agg(F.max(prefixes).alias("k")).agg(F.sum("k")).head()[0] or 0) // PART_ENTRIES))
    entries = staged(shared_prefixes(docs.where("doc_id is not null"), order, words, threshold, parts), "entries")
    whole = Window.partitionBy("prefix")
    entries = staged(entries.withColumns({"place": F.row_number().over(whole.orderBy("pos")) - 1, "shared": F.count("*").over(whole)}), "counted")

    first = entries.groupBy("token").agg(F.min(F.struct("pos", "size", "prefix", "place", "shared")).alias("l")).select("token", "l.*")
    groups = entries.alias("e").join(first.alias("l"), "token").where((F.col("e.prefix") != F.col("l.prefix")) & _passes("e", "l", threshold))
    groups = groups.select(F.col("e.prefix").alias("g"), F.col("l.prefix").alias("h")).distinct()
    g_members, h_members = members.select(F.col("prefix").alias("g"), F.col("doc").alias("x")), members.select(F.col("prefix").alias("h"), F.col("doc").alias("x"))
    g_leads, h_leads = leads.select(F.col("prefix").alias("g"), F.col("lead").alias("y")), leads.select(F.col("prefix").alias("h"), F.col("lead").alias("y"))
    within = g_members.join(g_leads, "g").where(F.col("x") != F.col("y")).select("x", "y")
    star = groups.join(g_members, "g").join(h_leads, "h").select("x", "y").unionByName(groups.join(h_members, "h").join(g_leads, "g").select("x", "y")).unionByName(within)
    tried = staged(star.where("x <> y").select(*_both("x", "y")).distinct(), "tried")
    repeated = sets.where("doc_id is not null and n > 0").groupBy("doc_id").agg(F.countDistinct("set1", "set2", "n").alias("k")).where("k > 1").select("doc_id")
    same = sets.join(repeated, "doc_id").join(classes.select("set1", "set2", "n", "rep"), ["set1", "set2", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = staged(verified(docs, tried, words, threshold).unionByName(same), "links")
    found = staged(connected_components(links), "components")

    placed = members.join(found.withColumnRenamed("node", "doc"), "doc", "left").select("prefix", "doc", F.coalesce("component", "doc").alias("component"))
    placed = staged(placed, "placed")
    spans = placed.groupBy("prefix").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = entries.join(spans, "prefix")
    holders = [F.count("*").alias("k"), F.bit_xor(F.xxhash64("prefix")).alias("h1"), F.bit_xor(F.xxhash64("prefix", F.lit(1))).alias("h2")]
    mixed = spread.groupBy("token").agg(F.min("low").alias("x"), F.max("high").alias("y"), *holders).where("x <> y")
    first_of = mixed.groupBy("k", "h1", "h2").agg(F.min(F.col("token").bitwiseXOR(F.lit(-(1 << 63)))).alias("t")).select(F.col("t").bitwiseXOR(F.lit(-(1 << 63))).alias("token"))
    rest = staged(spread.join(first_of, "token"), "rest")
    apart = (F.col("p.low") != F.col("p.high")) | (F.col("q.low") != F.col("q.high")) | (F.col("p.low") != F.col("q.low"))
    pairs = rest.alias("p").join(rest.alias("q"), "token").where((F.col("p.prefix") < F.col("q.prefix")) & apart & _passes("p", "q", threshold))
    pairs = pairs.select(F.col("p.prefix").alias("g"), F.col("q.prefix").alias("h")).distinct()
    divided = spans.where("low <> high").select(F.col("prefix").alias("g"), F.col("prefix").alias("h"))
    side = lambda k, v, c: placed.select(F.col("prefix").alias(k), F.col("doc").alias(v), F.col("component").alias(c))
    expanded = pairs.unionByName(divided).join(side("g", "x", "cx"), "g").join(side("h", "y", "cy"), "h").where("cx <> cy and x <> y").select(*_both("x", "y")).distinct()
    remaining = staged(expanded.join(tried, ["a", "b"], "left_anti"), "remaining")
    if not remaining.isEmpty():
        more = staged(verified(docs, remaining, words, threshold), "more")
        if not more.isEmpty():
            stars = found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = staged(connected_components(stars.unionByName(more)), "components")

    labels = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("set1", "set2", "n", F.coalesce("component", "rep").alias("component"))
    placed = sets.join(labels, ["set1", "set2", "n"], "left")
    named = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), named.alias("component_id"))
