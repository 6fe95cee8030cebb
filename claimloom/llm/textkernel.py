"""Vectorised work on the UTF-8 bytes of Arrow text columns.

Texts are cut into slices of whole rows so that temporary arrays stay small whatever the size of an Arrow
batch; one text longer than a slice forms a slice of its own and is still processed whole. Null texts count
as empty texts.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_MULTIPLIER = 0x9E3779B97F4A7C15
_RADIX = 0xD1342543DE82EF95
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)


#: What a worker process keeps from task to task, by the operator it is kept for.
KEPT: dict[str, dict] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def make_room(operator: str = "") -> None:
    """Drops what this process keeps for other operators and returns freed memory to the system."""
    for name, held in KEPT.items():
        if name != operator:
            held.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidy(kernel, operator: str = ""):
    """The kernel of a task, before and after which its worker process holds only what is kept for this operator.

    Workers outlive their tasks: what allocators hold after one stage would stand beside the next one's arrays.
    """

    def run(batches):
        make_room(operator)
        try:
            yield from kernel(batches)
        finally:
            make_room(operator)

    return run


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUES_LOWER = BYTE_VALUES[LOWER]

#: Bytes that belong to a word: not space and not one of the five controls from tab to carriage return.
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of letters, digits and of every character beyond ASCII.
ALNUM_BYTE = np.zeros(256, dtype=bool)
ALNUM_BYTE[0x30:0x3A] = ALNUM_BYTE[0x41:0x5B] = ALNUM_BYTE[0x61:0x7B] = True
ALNUM_BYTE[0x80:] = True


class _Powers:
    def __init__(self) -> None:
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, SLICE_BYTES)
            for name, radix in (("up", _RADIX), ("down", _RADIX_INVERSE)):
                steps = np.full(self.size, radix, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def text_slices(column: pa.Array, most: int = SLICE_BYTES):
    """Yields (first row, number of rows, bytes, offsets from 0) for consecutive runs of rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, n)
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes within rows: their starts, ends and rows."""
    n = len(member)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = member[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = member[1:]
    filled = offsets[1:] > offsets[:-1]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte runs; equal bytes (or equal up to A-Z case) give equal hashes."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((BYTE_VALUES_LOWER if lower else BYTE_VALUES)[data] * up[: len(data)], out=sums[1:])
    found = sums[ends] - sums[starts]
    found *= down[starts]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(_MULTIPLIER))


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many true bytes each row has."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = WORD_BYTE, lower: bool = False):
    """Hashes and rows of the words of a slice, and their starts and ends."""
    starts, ends, row = runs(member[data], offsets)
    return run_hashes(data, starts, ends, lower), row, starts, ends


_WINDOW_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def windows(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every n consecutive words of a row, and the index of each window's first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[n - 1 :] == row[: len(row) - n + 1])
    total = np.zeros(len(first), dtype=np.uint64)
    for k in range(n):
        total += hashes[first + k] * _WINDOW_FACTORS[k]
    return mix(total), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingle hashes of each row in a slice, sorted within the row, and their row bounds.

    Words are lower-cased in A-Z. A row with 1 to n - 1 words has one shingle, its whole sequence; a row
    without words has none.
    """
    hashes, row, _, _ = words(data, offsets, lower=True)
    rows = len(offsets) - 1
    found, first = windows(hashes, row, n)
    owner = row[first]
    count = np.bincount(row, minlength=rows)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        begin = np.searchsorted(row, short, "left")
        total = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            total[has] += hashes[begin[has] + k] * _WINDOW_FACTORS[k]
        found = np.concatenate([found, mix(total + count[short].astype(np.uint64) * np.uint64(_MULTIPLIER))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    edges = np.searchsorted(owner, np.arange(rows + 1))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        found[begin:end].sort()
    if len(found):
        keep = np.empty(len(found), dtype=bool)
        keep[0] = True
        keep[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        found, owner = found[keep], owner[keep]
    bounds = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(owner, minlength=rows), out=bounds[1:])
    return found, bounds


class HashTable:
    """Numbers of 64-bit keys in the order of their insertion, found by open addressing; keys must be well mixed."""

    def __init__(self, bits: int = 14) -> None:
        self.size, self.bits = 0, bits
        self.keys, self.slots = np.zeros(1 << bits >> 1, np.uint64), np.full(1 << bits, -1, np.int32)

    def _begin(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 where a key is not there."""
        at = self._begin(keys)
        found = self.slots[at]
        left = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            here = self.slots[at[left]]
            found[left] = here
            left = left[(here >= 0) & (self.keys[here] != keys[left])]
        return found

    def insert(self, keys: np.ndarray) -> None:
        """Adds distinct keys that are not there yet."""
        first, self.size = self.size, self.size + len(keys)
        if self.size > len(self.keys):
            while self.size > 1 << self.bits >> 1:
                self.bits += 1
            self.keys = np.concatenate([self.keys[:first], keys, np.zeros((1 << self.bits >> 1) - self.size, np.uint64)])
            self.slots = np.full(1 << self.bits, -1, np.int32)
            first = 0
        else:
            self.keys[first : self.size] = keys
        number = np.arange(first, self.size, dtype=np.int32)
        at = self._begin(self.keys[first : self.size])
        while len(number):
            free = self.slots[at] < 0
            self.slots[at[free]] = number[free]
            left = self.slots[at] != number
            number, at = number[left], (at[left] + 1) & (len(self.slots) - 1)


class Buffer:
    """A growing array."""

    def __init__(self, kind) -> None:
        self.size, self.data = 0, np.zeros(1024, kind)

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(max(end, 2 * len(self.data)) - self.size, self.data.dtype)])
        self.data[self.size : end] = values
        self.size = end


class IdCache:
    """Id lists of words by word hash: at most `most` words, then it starts anew."""

    def __init__(self, most: int, kind) -> None:
        self.most, self.kind = most, kind
        self.forget()

    def forget(self) -> None:
        self.table = HashTable()
        self.begin, self.length, self.ids = Buffer(np.int64), Buffer(np.int64), Buffer(self.kind)

    def expand(self, hashes: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in order, and each word's number of ids.

        learn(at) gives ids and lengths, word by word, of the words at these places, whose hashes are not known.
        """
        found = self.table.find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            keys, first = np.unique(hashes[missing], return_index=True)
            if self.table.size and self.table.size + len(keys) > self.most:
                self.forget()
                keys, first = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
            ids, lengths = learn(missing[first])
            self.begin.add(self.ids.size + np.cumsum(lengths) - lengths)
            self.length.add(lengths)
            self.ids.add(ids)
            self.table.insert(keys)
            found[missing] = self.table.find(hashes[missing])
        length = self.length.data[found]
        total = np.cumsum(length)
        return self.ids.data[np.repeat(self.begin.data[found] - (total - length), length) + np.arange(total[-1] if len(total) else 0)], length
