"""Packing: best-fit decreasing into token windows, with a segment tree over remaining capacities.

Each input task packs its own documents, in blocks of bounded size: a block's documents are cut into full
windows and a rest, rests are placed in order of decreasing length into the tightest open window that has room,
and windows left open are offered to the task's next block. Nothing is shuffled, and a task that runs again gives
the same pieces.

Token ids are those of the `tokenizers` library. A word is encoded once for each worker process and then looked up by the
hash of its bytes (lower-cased where the vocabulary's own normaliser lower-cases it); words that contain anything
but ASCII and the letters from U+00C0 to U+00FF, and words with apostrophes or control strings, are encoded by the
whole tokenizer.

Defined results: a null or empty text has the end id only. Rows are packed one by one, so repeated rows and ids
each have their pieces. An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import textkernel as tk

WINDOW = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
_BLOCK_TOKENS = 1 << 22
_CACHE_WORDS = 600_000


class CapacityTree:
    """Numbers of open windows by remaining capacity; finds the smallest capacity of at least a given size."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._change(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The window with the least capacity of at least `size`, removed from the tree."""
        node = size + self.leaves
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return capacity, self.open[capacity].pop()


#: What a byte is: 0 space, 1 letter, 2 digit, 3 other ASCII, 4 first or 5 second byte of a Latin-1 letter, 6 anything else.
_KIND = np.full(256, 6, dtype=np.uint8)
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KIND[ord("'")] = 6
_KIND[0x80:0xC0] = 5
_KIND[0xC3] = 4


class WordEncoder:
    """Token ids of texts, word by word."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.plain.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.cache = tk.IdCache(_CACHE_WORDS, np.uint32)

    def _units(self, data: np.ndarray, offsets: np.ndarray):
        """Runs of bytes that are encoded on their own: their bytes lower-cased, starts, ends, rows and whether plain."""
        kind = _KIND[data]
        start, end, row = tk.runs(kind != 0, offsets)
        lowered = tk.LOWER[data]
        odd = kind == 6
        lead = np.flatnonzero(kind == 4)
        following = np.zeros(len(data) + 1, dtype=np.uint8)
        following[:-1] = data
        second = following[lead + 1]
        letter = (second >= 0x80) & (second < 0xC0) & (second != 0x97) & (second != 0xB7)
        odd[lead[~letter]] = True
        covered = np.zeros(len(data), dtype=bool)
        covered[lead[letter] + 1] = True
        odd |= (kind == 5) & ~covered
        upper = lead[letter & (second < 0x9F)] + 1
        lowered[upper] += 0x20
        sums = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(odd | ((data == 0x3C) & (following[1:] == 0x7C)), out=sums[1:])
        plain = sums[end] == sums[start]
        kind[(kind == 4) | (kind == 5)] = 1
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[start[plain]] += 1
        inside[end[plain]] -= 1
        inside = np.cumsum(inside[:-1]).astype(bool)
        breaks = np.zeros(len(data) + 1, dtype=bool)
        breaks[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        breaks[start] = True
        starts = np.flatnonzero(breaks[:-1] & inside)
        breaks[end] = True
        stops = np.flatnonzero(breaks)
        ends = stops[np.searchsorted(stops, starts, "right")]
        other = ~plain
        starts, ends = np.concatenate([starts, start[other]]), np.concatenate([ends, end[other]])
        is_plain = np.arange(len(starts)) < len(starts) - other.sum()
        at = np.argsort(starts, kind="stable")
        starts, ends, is_plain = starts[at], ends[at], is_plain[at]
        return lowered, starts, ends, np.searchsorted(offsets, starts, "right") - 1, is_plain

    def _learn(self, words: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and each word's number of ids."""
        lengths, found = np.zeros(len(words), dtype=np.int64), []
        simple, other = np.flatnonzero(plain), np.flatnonzero(~plain)
        if len(simple):
            encoded = self.plain.encode(" ".join(words[i] for i in simple), add_special_tokens=False)
            found.append(np.array(encoded.ids, dtype=np.uint32))
            lengths[simple] = np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(simple))
        if len(other):
            for i, x in zip(other.tolist(), self.whole.encode_batch_fast([words[i] for i in other], add_special_tokens=False), strict=True):
                found.append(np.array(x.ids, dtype=np.uint32))
                lengths[i] = len(x.ids)
        ids = np.concatenate(found)
        order = np.concatenate([simple, other])
        begin = np.zeros(len(words), dtype=np.int64)
        begin[order] = np.cumsum(lengths[order]) - lengths[order]
        total = np.cumsum(lengths)
        return ids[np.repeat(begin - (total - lengths), lengths) + np.arange(len(ids))], lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and their bounds by row."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        lowered, starts, ends, row, plain = self._units(data, offsets)
        hashes = tk.run_hashes(lowered, starts, ends)
        if not plain.all():
            exact = tk.run_hashes(data, starts[~plain], ends[~plain])
            hashes[~plain] = tk.mix(exact + np.uint64(0x9E3779B97F4A7C15))

        def learn(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            text, raw = lowered.tobytes(), data.tobytes()
            words = [(text if p else raw)[b:e].decode("utf-8", "replace") for p, b, e in zip(plain[at].tolist(), starts[at].tolist(), ends[at].tolist(), strict=True)]
            return self._learn(words, plain[at])

        ids, length = self.cache.expand(hashes, learn)
        bounds = np.zeros(rows + 1, dtype=np.int64)
        np.cumsum(np.bincount(row, weights=length, minlength=rows).astype(np.int64), out=bounds[1:])
        return ids, bounds


_ENCODERS: dict[str, WordEncoder] = {}
tk.KEPT["packing"] = _ENCODERS


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary; a worker process keeps it, and the words it has met, from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encode_texts(column: pa.Array, encoder: WordEncoder, end_id: int = END_ID):
    """Yields each text's ids with the end id, in order."""
    for _, n, data, offsets in tk.text_slices(column):
        ids, bounds = encoder.encode(data, offsets)
        for i in range(n):
            yield np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id))


class Packer:
    """Places documents of one task; pieces are (document, start, length, sequence, offset)."""

    def __init__(self, window: int) -> None:
        self.window, self.tree, self.sequences = window, CapacityTree(window), 0

    def place(self, lengths: list[int]) -> list[tuple[int, int, int, int, int]]:
        pieces, rests = [], []
        for i, length in enumerate(lengths):
            full = length // self.window
            for k in range(full):
                pieces.append((i, k * self.window, self.window, self.sequences, 0))
                self.sequences += 1
            if length % self.window:
                rests.append((length % self.window, i, full * self.window))
        rests.sort(key=lambda x: (-x[0], x[1]))
        for length, i, start in rests:
            found = self.tree.take(length)
            if found is None:
                found = self.window, self.sequences
                self.sequences += 1
            capacity, sequence = found
            pieces.append((i, start, length, sequence, self.window - capacity))
            if capacity > length:
                self.tree.add(capacity - length, sequence)
        return pieces


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of docs(doc_id, text): (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    A sequence is padded to the window. with_ids adds the pieces' ids as little-endian unsigned 32-bit integers,
    for `sequences`.
    """
    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids binary" * with_ids

    def pack(batches):
        encoder, packer = word_encoder(tokenizer), Packer(window)
        base = TaskContext.get().partitionId() << 40
        names, held, size = [], [], 0

        def out():
            pieces = packer.place([len(x) for x in held])
            parts = [np.ascontiguousarray(held[i][s : s + n], "<u4") for i, s, n, _, _ in pieces]
            columns = [
                pa.array([names[p[0]] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([zlib.crc32(x) for x in parts], pa.int64()), pa.array([len(held[p[0]]) for p in pieces], pa.int64()),
                pa.array([base + p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int64()),
            ]
            labels = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(columns + [pa.array([x.tobytes() for x in parts] if with_ids else [], pa.binary())] * with_ids, labels + ["ids"] * with_ids)

        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for name, x in zip(ids, encode_texts(batch.column("text"), encoder, end_id), strict=True):
                names.append(name)
                held.append(x)
                size += len(x)
                if size > _BLOCK_TOKENS:
                    yield out()
                    names, held, size = [], [], 0
        if held:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(tk.tidy(pack, "packing"), fields)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids) of whole padded windows from pieces with ids."""
    from pyspark.sql import functions as F

    joined = F.aggregate(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]), F.lit(b""), lambda a, x: F.concat(a, x))
    pad = F.lit(int(pad_id).to_bytes(4, "little") * window)
    grouped = pieces.groupBy("sequence_id").agg(joined.alias("ids"))
    return grouped.select("sequence_id", F.substring(F.concat("ids", pad), 1, 4 * window).alias("ids"))
