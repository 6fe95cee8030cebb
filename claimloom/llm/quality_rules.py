"""Quality rules: word and line statistics of whole texts, and perplexity bands of a Spark-counted language model.

The model is an interpolated modified Kneser-Ney model over the bytes of UTF-8 text, as they are, so every character of
every script counts in full; each language has its own. Spark counts the n-grams of all documents and computes every
probability with joins and aggregations. What scoring needs is linear in the n-grams of a text: each context h adds
log gamma(h) and each seen n-gram adds log p(n-gram) - log gamma(its context) - log p(its suffix). N-grams that stand in one place of the corpus shape the
discounts and back-off weights, and scoring treats them as unseen, or each text would vouch for itself. These addends are
stored in arrays sorted by 64-bit hash. An array holds at most about `block_entries` entries; a larger model has more
arrays. Each is broadcast on its own; a task reads its texts once, and has one array in memory at a time while it
adds up what the n-grams it has not met yet get from all of them, so no model size changes a result.

Defined results: null or empty texts have zero counts, base_failed true and no perplexity. Nulls in lang form a
language of their own. Rows are judged one by one, so repeated rows and doc_ids each get their row. Columns
other than doc_id, text and lang are ignored. An empty table gives an empty result. Bands come from documents
with at least `least_words` words; a language without such documents rejects nothing.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as tk
from .staging import staged

ORDER = 5
LEAST_WORDS = 50
BLOCK_ENTRIES = 4_000_000
#: How many distances from the median to the quantile at one standard deviation a band reaches down and up.
#: The README has the documents that several widths reject.
BAND_WIDTH = 3.0
BIN = 0.001
#: A byte that no UTF-8 text has.
_PAD = 0xFF
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CACHE_ENTRIES = 1_000_000
_GRAM, _CONTEXT, _WHOLE = 1, 2, 3


def _salt(lang: str, kind: int, order: int) -> np.uint64:
    seed = int.from_bytes(hashlib.sha256(lang.encode()).digest()[:7], "little") + kind * 64 + order
    return tk.mix(np.array([seed * 0x9E3779B97F4A7C15 % (1 << 64)], dtype=np.uint64))[0]


def _hash(keys: np.ndarray, lang: str, kind: int, order: int) -> np.ndarray:
    """64-bit hashes of packed n-grams; languages, kinds and orders have hash spaces of their own."""
    return tk.mix(keys * np.uint64(0xD1342543DE82EF95) + _salt(lang, kind, order))


def _keys(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each byte, eight bits a byte; before its first byte a text has padding."""
    single = data.astype(np.uint64)
    keys = single.copy()
    begins = offsets[:-1][offsets[1:] > offsets[:-1]]
    length = offsets[1:][offsets[1:] > offsets[:-1]] - begins
    for k in range(1, order):
        keys[k:] |= single[:-k] << np.uint64(8 * k)
        for i in range(k):  # the padding that the k-th byte before position i of a text is
            keys[begins[length > i] + i] |= np.uint64(_PAD << (8 * k))
    return keys


def _by_language(batch: pa.RecordBatch):
    """Yields (language, row numbers, bytes, offsets) for slices of rows in one language; null is a language."""
    langs = batch.column("lang").to_pylist()
    rows: dict[str, list[int]] = {}
    for i, x in enumerate(langs):
        rows.setdefault("" if x is None else "=" + x, []).append(i)
    for lang, index in rows.items():
        index = np.array(index, dtype=np.int64)
        for first, n, data, offsets in tk.text_slices(batch.column("text").take(pa.array(index))):
            yield lang, index[first : first + n], data, offsets


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of all byte n-grams of the highest order: (lang, gram, n)."""

    def count(batches):
        parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def merge() -> int:
            for lang, found in parts.items():
                if len(found) > 1:
                    keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
                    at = np.argsort(keys)
                    keys, sums = keys[at], np.concatenate([[0], np.cumsum(counts[at])])
                    last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
                    parts[lang] = [(keys[last], np.diff(np.concatenate([[0], sums[last + 1]])))]
            return sum(len(k) for found in parts.values() for k, _ in found)

        def out():
            for lang, found in parts.items():
                for keys, counts in found:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], ["lang", "gram", "n"])
            parts.clear()

        for batch in batches:
            for lang, _, data, offsets in _by_language(batch):
                if len(data):
                    keys = np.sort(_keys(data, offsets, order))
                    last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
                    parts.setdefault(lang, []).append((keys[last], np.diff(last, prepend=-1)))
                    held += len(last)
                    if held > _CACHE_ENTRIES:
                        held = merge()
                        if held > _CACHE_ENTRIES // 2:
                            yield from out()
                            held = 0
        merge()
        yield from out()

    counted = docs.select("text", "lang").mapInArrow(tk.tidy(count), "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Addends of an interpolated modified Kneser-Ney model: (lang, kind, n, gram, value).

    The highest order uses the counts, lower orders the number of distinct bytes before an n-gram. An
    entry of kind 2 is log gamma of a context; one of kind 1 what a seen n-gram adds beside its context.
    Entries of kind 0 hold log(gamma / alphabet) for each language: what any byte gets first.

    What stands in one place only has no entry: it counts in discounts and totals, but a text is not to find its own
    oddities familiar.
    """
    levels = [counts.select("lang", "gram", F.col("n").cast("double").alias("c"), F.col("n").alias("places"))]
    for n in range(order - 1, 0, -1):
        shorter = levels[0].groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1)).alias("gram"))
        levels.insert(0, staged(shorter.agg(F.count("*").cast("double").alias("c"), F.sum("places").alias("places")), f"level{n}"))
    seen = _weighed(levels)
    contexts = seen.where("heads")
    model = contexts.where("n = 1").select("lang", F.lit(0).alias("kind"), F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("gram"), F.col("base").alias("value"))
    model = model.unionByName(contexts.where("n > 1").select("lang", F.lit(_CONTEXT).alias("kind"), (F.col("n") - 1).alias("n"), F.col("h").alias("gram"), F.log("gamma").alias("value")))
    lower = None
    for n in range(1, order + 1):
        grams = seen.where((F.col("n") == n) & (F.col("places") > 1))
        if n == 1:
            found = grams.select("lang", "gram", F.log(F.col("direct") + F.exp("base")).alias("logp"), F.col("base").alias("rest"))
        else:
            found = (
                grams.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)))
                .join(lower.select("lang", F.col("gram").alias("suffix"), F.col("logp").alias("below")), ["lang", "suffix"])
                .select("lang", "gram", F.log(F.col("direct") + F.col("gamma") * F.exp("below")).alias("logp"), (F.log("gamma") + F.col("below")).alias("rest"))
            )
        if 1 < n < order:  # the highest order is read once
            found = staged(found, f"order{n}")
        model = model.unionByName(found.select("lang", F.lit(_GRAM).alias("kind"), F.lit(n).alias("n"), "gram", (F.col("logp") - F.col("rest")).alias("value")))
        lower = found
    return model


def _weighed(levels: list[DataFrame]) -> DataFrame:
    """N-grams of all orders with what they and their contexts weigh: (lang, n, gram, h, places, heads, direct, gamma, base).

    The orders go through the same few jobs, or the driver keeps plans and task figures of each. A context has at most 256
    n-grams. `heads` marks one n-gram of each context that has an entry; n-grams that stand in one place stay only for that.
    """
    grams = None
    for n, level in enumerate(levels, 1):
        level = level.withColumn("n", F.lit(n))
        grams = level if grams is None else grams.unionByName(level)
    bucket = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))
    safe = lambda d, most: F.least(F.greatest(F.coalesce(d, F.lit(0.5)), F.lit(0.05)), F.lit(most))
    discounts = grams.groupBy("lang", "n").agg(*bucket).select(
        "lang",
        "n",
        safe(1 - 2 * y * F.col("n2") / F.nullif(F.col("n1"), F.lit(0.0)), 0.95).alias("d1"),
        safe(2 - 3 * y * F.col("n3") / F.nullif(F.col("n2"), F.lit(0.0)), 1.95).alias("d2"),
        safe(3 - 4 * y * F.col("n4") / F.nullif(F.col("n3"), F.lit(0.0)), 2.95).alias("d3"),
    )
    d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = Window.partitionBy("lang", "n", "h")
    weighed = (
        grams.join(F.broadcast(discounts), ["lang", "n"])
        .select("lang", "n", "gram", "c", "places", F.least(d, F.col("c")).alias("d"), F.shiftrightunsigned("gram", 8).alias("h"))
        .select(
            "lang", "n", "gram", "h", "c", "places", "d", F.sum("c").over(context).alias("total"), F.sum("d").over(context).alias("mass"),
            F.count("*").over(context).alias("kinds"), F.sum("places").over(context).alias("around"), F.min("gram").over(context).alias("first"),
        )
    )
    heads = (F.col("gram") == F.col("first")) & ((F.col("around") > 1) | (F.col("n") == 1))
    gamma = F.col("mass") / F.col("total")
    base = F.when(F.col("n") == 1, F.log(gamma / (F.col("kinds") + 1)))
    weighed = weighed.select("lang", "n", "gram", "h", "places", heads.alias("heads"), ((F.col("c") - F.col("d")) / F.col("total")).alias("direct"), gamma.alias("gamma"), base.alias("base"))
    return staged(weighed.where("heads or places > 1"), "weighed")


def hash_blocks(model: DataFrame, block_entries: int = BLOCK_ENTRIES) -> tuple[DataFrame, int]:
    """The model as rows (block, hashes, values) of arrays sorted by hash, at most about block_entries each."""

    def hashed(batches):
        for batch in batches:
            lang, kind, n = (pd_column.to_numpy(zero_copy_only=False) for pd_column in (batch.column("lang"), batch.column("kind"), batch.column("n")))
            keys = batch.column("gram").to_numpy().view(np.uint64)
            found = np.zeros(len(keys), dtype=np.uint64)
            for group in set(zip(lang, kind.tolist(), n.tolist(), strict=True)):
                at = (lang == group[0]) & (kind == group[1]) & (n == group[2])
                found[at] = _hash(keys[at], *group)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), batch.column("value")], ["hash", "value"])

    entries = staged(model.mapInArrow(tk.tidy(hashed), "hash bigint, value double"), "model")
    blocks = max(1, math.ceil(entries.count() / block_entries))

    def packed(pdf):
        import pandas as pd

        order = np.argsort(pdf["hash"].to_numpy().view(np.uint64))
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "hashes": [pdf["hash"].to_numpy()[order].tobytes()], "values": [pdf["value"].to_numpy()[order].astype(np.float32).tobytes()]})

    rows = entries.withColumn("block", F.pmod("hash", F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(packed, "block int, hashes binary, values binary")
    return staged(rows, "blocks"), blocks


class _Scorer:
    """Log probabilities of the bytes that n-grams end in, remembered for the n-grams met last."""

    def __init__(self, arrays: list, order: int) -> None:
        self.arrays, self.order = arrays, order
        self._forget()

    def _forget(self) -> None:
        self.table, self.scores = tk.HashTable(), tk.Buffer(np.float64)

    def unknown(self, lang: str, keys: np.ndarray) -> np.ndarray:
        names = _hash(keys, lang, _WHOLE, self.order)
        missing = np.flatnonzero(self.table.find(names) < 0)
        return keys[missing[np.unique(names[missing], return_index=True)[1]]]

    def _addends(self, lang: str, keys: np.ndarray, hashes: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(keys))

        def add(names: np.ndarray) -> None:
            at = np.minimum(np.searchsorted(hashes, names), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == names)
            total[hit] += values[at[hit]]

        if len(hashes):
            add(_hash(keys & np.uint64(0), lang, 0, 0))
            for n in range(1, self.order + 1):
                gram = keys & np.uint64((1 << 8 * n) - 1)
                add(_hash(gram, lang, _GRAM, n))
                if n > 1:
                    add(_hash(gram >> np.uint64(8), lang, _CONTEXT, n - 1))
        return total

    def learn(self, pending: dict[str, list[np.ndarray]]) -> None:
        """Sums up, array by array, what these n-grams get."""
        new = [(lang, self.unknown(lang, np.concatenate(parts))) for lang, parts in pending.items() if parts]
        sums = [np.zeros(len(keys)) for _, keys in new]
        for array in self.arrays:
            hashes, values = (np.frombuffer(x, kind) for x, kind in zip(array.value, (np.uint64, np.float32), strict=True))
            for (lang, keys), total in zip(new, sums, strict=True):
                total += self._addends(lang, keys, hashes, values)
            if len(self.arrays) > 1:  # a worker has room for one array, not for all
                array.__dict__.pop("_value", None)
        if self.table.size and self.table.size + sum(len(x) for x in sums) > _CACHE_ENTRIES:
            self._forget()
        for (lang, keys), total in zip(new, sums, strict=True):
            self.table.insert(_hash(keys, lang, _WHOLE, self.order))
            self.scores.add(total)

    def score(self, lang: str, keys: np.ndarray) -> np.ndarray:
        names = _hash(keys, lang, _WHOLE, self.order)
        found = self.table.find(names)
        if (found < 0).any():  # what was known was forgotten to make room
            self.learn({lang: [keys]})
            found = self.table.find(names)
        if (found < 0).any():
            self._forget()
            self.learn({lang: [keys]})
            found = self.table.find(names)
        return self.scores.data[found]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    found = np.zeros(len(bounds) - 1)
    filled = bounds[1:] > bounds[:-1]
    if filled.any():
        found[filled] = np.add.reduceat(values, bounds[:-1][filled])
    return found


def base_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Word, line, symbol and repetition counts of each row in a slice."""
    rows = len(offsets) - 1
    member = tk.WORD_BYTE[data]
    hashes, row, starts, ends = tk.words(data, offsets)
    in_doc = np.uint64(0x9E3779B97F4A7C15)
    window, first = tk.windows(hashes, row, 3)
    repeated = np.zeros(len(hashes) + 3, dtype=bool)
    if len(window):
        _, inverse, count = np.unique(window ^ tk.mix(row[first].astype(np.uint64) * in_doc), return_inverse=True, return_counts=True)
        again = first[count[inverse] > 1]
        for k in range(3):
            repeated[again + k] = True
    repeated = repeated[: len(hashes)]
    line_start, line_end, line_row = tk.runs(data != 10, offsets)
    has_word = np.searchsorted(starts, line_end, "left") > np.searchsorted(starts, line_start, "left")
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    duplicate = np.zeros(rows, dtype=np.int64)
    if len(line_start):
        keys = tk.run_hashes(data, line_start, line_end) ^ tk.mix(line_row.astype(np.uint64) * in_doc)
        _, firsts = np.unique(keys, return_index=True)
        duplicate = np.bincount(line_row, minlength=rows) - np.bincount(line_row[firsts], minlength=rows)
    return {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": tk.per_row(member & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": tk.per_row(_SYMBOL[data], offsets),
        "n_dup_lines": duplicate,
        "n_repeat_words": np.bincount(row[repeated], minlength=rows),
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score_documents(docs: DataFrame, blocks: DataFrame, n_blocks: int, order: int = ORDER) -> DataFrame:
    """Base statistics, bytes and log probability of each document: (doc_id, lang, counts..., n_bytes, logp)."""
    spark = docs.sparkSession
    fields = "doc_id bigint, lang string, " + ", ".join(f"{x} bigint" for x in _COUNTS) + ", n_bytes bigint, logp double"
    names = ["doc_id", "lang", *_COUNTS, "n_bytes", "logp"]

    def shared(block: int):
        rows = blocks.where(F.col("block") == block).select("hashes", "values").toArrow()  # rows of Python would be copied within the JVM
        return spark.sparkContext.broadcast(tuple(column[0].as_buffer().to_pybytes() if rows.num_rows else b"" for column in rows.columns))

    arrays = [shared(block) for block in range(n_blocks)]

    def score(batches):
        scorer = _Scorer(arrays, order)
        for batch in batches:
            pending: dict[str, list[np.ndarray]] = {}
            held = 0
            for lang, _, data, offsets in _by_language(batch):
                pending.setdefault(lang, []).append(scorer.unknown(lang, _keys(data, offsets, order)))
                held += len(pending[lang][-1])
                if held > _CACHE_ENTRIES // 2:
                    scorer.learn(pending)
                    pending, held = {}, 0
            scorer.learn(pending)
            found = {x: np.zeros(batch.num_rows, np.float64 if x == "logp" else np.int64) for x in names[2:]}
            for lang, rows, data, offsets in _by_language(batch):
                for name, values in base_statistics(data, offsets).items():
                    found[name][rows] = values
                found["logp"][rows] = _sums(scorer.score(lang, _keys(data, offsets, order)), offsets)
                found["n_bytes"][rows] = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("lang")] + [pa.array(found[x]) for x in names[2:]], names)

    return docs.select("doc_id", "text", "lang").mapInArrow(tk.tidy(score), fields)


def perplexity_bands(scored: DataFrame, least_words: int = LEAST_WORDS, width: float = BAND_WIDTH) -> DataFrame:
    """(lang, low, high): log perplexities between which a language's documents lie.

    Quantiles come from whole histograms with bins of 0.001, so they do not depend on how rows are dealt out.
    """
    usable = scored.where((F.col("n_words") >= least_words) & (F.col("n_bytes") > 0))
    bins = usable.groupBy("lang", F.floor(-F.col("logp") / F.col("n_bytes") / BIN).alias("bin")).agg(F.count("*").alias("n"))
    below = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    placed = bins.select("lang", "bin", (below / total).alias("share"))
    at = lambda q: F.min(F.when(F.col("share") >= q, F.col("bin"))) * BIN
    marks = placed.groupBy("lang").agg(at(0.16).alias("q16"), at(0.5).alias("q50"), at(0.84).alias("q84"))
    floor = F.lit(10 * BIN)
    return marks.select(
        "lang",
        (F.col("q50") - width * F.greatest(F.col("q50") - F.col("q16"), floor)).alias("low"),
        (F.col("q50") + width * F.greatest(F.col("q84") - F.col("q50"), floor)).alias("high"),
    )


def quality_rules(docs: DataFrame, order: int = ORDER, width: float = BAND_WIDTH, least_words: int = LEAST_WORDS, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(doc_id, counts, perplexity, band, base_failed, kept) for every row of docs(doc_id, text, lang)."""
    model = kneser_ney(staged(count_ngrams(docs, order), "ngrams"), order)
    blocks, n_blocks = hash_blocks(model, block_entries)
    scored = staged(score_documents(docs, blocks, n_blocks, order), "scored")
    bands = perplexity_bands(scored, least_words, width)
    joined = scored.alias("s").join(F.broadcast(bands).alias("b"), F.col("s.lang").eqNullSafe(F.col("b.lang")), "left")
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    level = F.when(F.col("n_bytes") > 0, -F.col("logp") / F.col("n_bytes"))
    inside = F.coalesce((level >= F.col("low")) & (level <= F.col("high")), F.lit(True))
    return joined.select(
        "doc_id", *_COUNTS, base_failed.alias("base_failed"), (~base_failed & inside).alias("kept"),
        F.exp(level).alias("perplexity"), F.exp("low").alias("lower_band"), F.exp("high").alias("upper_band"),
    )
