"""SentencePiece encoding and decoding: a batched numpy Viterbi over words of equal length.

Words (a space mark and what follows up to the next one) that have the same number of characters advance together.
For every end position and piece length a substring hash probes the sorted piece keys; of the candidates that may
follow the best piece before them, the longest is kept and its length stored as backpointer. A byte-pair model
does not maximise a sum of scores, so a candidate's score is not added up: it may follow the piece before it if
merging by scores would leave the two apart, and exactly one piece at each position can. The ids are thereby those
of the `sentencepiece` library. Characters without a piece become bytes. Words of more than `LONGEST` characters, such
as texts without spaces, are first cut where two neighbouring characters stand side by side in no piece, so that
many short parts advance together; a part without such a place goes through the recursion whole, however long.

Defined results: a null or empty text has no ids; no ids decode to an empty text. A null id list is empty. The mark
U+2581 in a text is read as a space, as the model's own normaliser does, so only that character does not survive a
round trip. Rows are coded one by one, so repeated rows each get their own; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkernel as tk

MODEL = "piece_bpe_32k.model"
#: Characters from which on a word is cut where no piece can span.
LONGEST = 48
_MARK = "▁"
_CACHE_WORDS = 600_000
#: Larger slices give the recursion more words of one length at a time, and a worker more arrays to hold.
_SLICE_BYTES = 1 << 20
_WORDS_AT_ONCE = 16_384
#: Cells of the candidate table for words that advance together.
_CELLS = 1 << 21
#: Pairs of pieces whose relation a worker remembers.
_PAIRS = 1 << 20
_ROWS_AT_ONCE = 256
_FAR = 1 << 30


class PieceModel:
    """Pieces of a byte-pair model with the tables that encoding and decoding probe."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(self.size)]
        kinds = [0 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 2 if model.is_byte(i) else 1 for i in range(self.size)]
        self.byte_ids = np.zeros(256, dtype=np.int64)
        self.bytes: list[bytes] = []
        for i, (text, kind) in enumerate(zip(texts, kinds, strict=True)):
            if kind == 2:
                self.byte_ids[int(text[3:5], 16)] = i
            self.bytes.append(b"" if kind == 0 else bytes([int(text[3:5], 16)]) if kind == 2 else text.replace(_MARK, " ").encode())
        self.unknown = model.unk_id()
        self.bytes[self.unknown] = b" \xe2\x81\x87 "
        self.ids = {text: i for i, (text, kind) in enumerate(zip(texts, kinds, strict=True)) if kind == 1}
        scores = np.array([model.get_score(i) for i in range(self.size)])
        self.rank = np.zeros(self.size, dtype=np.int64)
        _, self.rank[:] = np.unique(-scores, return_inverse=True)
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        whole = []
        for text, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
            found, last = self.merged(text, trace=True)
            if len(found) == 1:
                whole.append((text, i))
                if last:
                    self.left[i], self.right[i] = last
        self.longest = max(len(text) for text, _ in whole)
        keys = np.array([self._key(np.array([[ord(c) for c in text]]))[0] for text, _ in whole], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array([i for _, i in whole])[order]
        pairs = {}
        for text, i in self.ids.items():
            for k in range(1, len(text)):
                a, b = self.ids.get(text[:k]), self.ids.get(text[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = int(self.rank[i])
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = np.array([pairs[int(x)] for x in self.pairs], dtype=np.int64)
        self.neighbours = np.array(sorted({ord(a) << 32 | ord(b) for text in self.ids for a, b in zip(text, text[1:], strict=False)}), dtype=np.int64)
        self._forget_pairs()

    def _forget_pairs(self) -> None:
        self.met, self.fine = tk.HashTable(), tk.Buffer(bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("met", "fine")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget_pairs()

    @staticmethod
    def _key(codes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(codes), dtype=np.uint64)
        for k in range(codes.shape[1]):
            found = found * np.uint64(0xD1342543DE82EF95) + codes[:, k].astype(np.uint64) + np.uint64(1)
        return found

    def merged(self, text: str, trace: bool = False):
        """The pieces of one word by merging the best-scored neighbours first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                both = parts[i] + parts[j]
                if both in self.ids:
                    heapq.heappush(heap, (int(self.rank[self.ids[both]]), i, j, both))

        for i in range(len(parts)):
            offer(i)
        last = None
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            last = self.ids.get(parts[i], -1), self.ids.get(parts[j], -1)
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        found = [x for x in parts if x is not None]
        return (found, last) if trace else found

    def piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [int(self.byte_ids[b]) for b in piece.encode("utf-8", "surrogatepass")]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece a and the following piece b apart; pairs are worked out once and remembered."""
        keys = tk.mix((a << 32 | (b & 0xFFFFFFFF)).view(np.uint64))
        found = self.met.find(keys)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            if self.met.size + len(new) > _PAIRS:
                self._forget_pairs()
                return self._worked_out(a, b)
            self.fine.add(self._worked_out(a[missing[first]], b[missing[first]]))
            self.met.insert(new)
            found[missing] = self.met.find(keys[missing])
        return self.fine.data[found]

    def _worked_out(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves piece a and the following piece b apart; ids below 0 never merge.

        The merges that built the two are undone from the last. While x and y stand at the border, merging them
        would come before either is consumed if its rank is less than that of x's next merge and not more than
        that of y's; then the pieces would not have come about.
        """
        fine = np.ones(len(a), dtype=bool)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        x, y = a[at], b[at]
        x_next, y_next = np.full(len(at), _FAR), np.full(len(at), _FAR)
        while len(at):
            key = x << 32 | y
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.where(self.pairs[place] == key, self.pair_rank[place], _FAR)
            crossed = (rank < x_next) & (rank <= y_next)
            fine[at[crossed]] = False
            x_leaf, y_leaf = self.right[x] < 0, self.left[y] < 0
            undo_x = ~x_leaf & (y_leaf | (self.rank[x] > self.rank[y]))
            x_next, y_next = np.where(undo_x, self.rank[x], x_next), np.where(undo_x, y_next, self.rank[y])
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            go = ~crossed & ~(x_leaf & y_leaf)
            at, x, y, x_next, y_next = at[go], x[go], y[go], x_next[go], y_next[go]
        return fine

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words in equal-length rows of code points: the piece that ends at each position, and its length."""
        n, length = codes.shape
        best = np.full((length + 1, n), -1, dtype=np.int64)
        back = np.zeros((length + 1, n), dtype=np.int32)
        letters = np.ascontiguousarray(codes.T).astype(np.uint64) + np.uint64(1)
        hashes = np.zeros((length, n), dtype=np.uint64)
        candidates: list[np.ndarray] = [letters]
        somewhere = np.zeros((min(self.longest, length) + 1, length), dtype=bool)
        for size in range(1, len(somewhere)):
            hashes = hashes[: length - size + 1] * np.uint64(0xD1342543DE82EF95) + letters[size - 1 :]
            place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            candidates.append(np.where(self.keys[place] == hashes, self.key_ids[place], -1).astype(np.int32))
            somewhere[size, : length - size + 1] = (candidates[-1] >= 0).any(axis=1)
        for end in range(1, length + 1):
            open_ = np.arange(n)
            for size in range(min(end, len(somewhere) - 1), 0, -1):
                if size > 1 and not somewhere[size, end - size]:
                    continue
                piece = candidates[size][end - size, open_].astype(np.int64)
                if size > 1:
                    maybe = np.flatnonzero(piece >= 0)
                    if end > size and len(maybe):
                        maybe = maybe[self._apart(best[end - size, open_[maybe]], piece[maybe])]
                    if not len(maybe):
                        continue
                else:
                    maybe = np.arange(len(open_))
                rows = open_[maybe]
                best[end, rows], back[end, rows] = piece[maybe], size
                keep = np.ones(len(open_), dtype=bool)
                keep[maybe] = False
                open_ = open_[keep]
                if not len(open_):
                    break
        return best.T, back.T

    def _parts(self, word: str) -> list[str]:
        """A word cut where its neighbouring characters stand side by side in no piece."""
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pairs = codes[:-1] << 32 | codes[1:]
        together = self.neighbours[np.minimum(np.searchsorted(self.neighbours, pairs), len(self.neighbours) - 1)] == pairs
        cuts = [0, *(np.flatnonzero(~together) + 1).tolist(), len(word)]
        return [word[b:e] for b, e in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each starting with a space mark: all ids in order, and each word's number of ids."""
        parts, owner = [], []
        for i, word in enumerate(words):
            if len(word) > LONGEST:
                some = self._parts(word)
                parts += some
                owner += [i] * len(some)
            else:
                parts.append(word)
                owner.append(i)
        sizes = np.array([len(x) for x in parts], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        found: list[tuple[np.ndarray, ...]] = []
        edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            length = int(sizes[order[first]])
            step = max(1, _CELLS // max(length, 1))
            for begin in range(first, last, step):
                some = order[begin : min(begin + step, last)]
                codes = np.frombuffer("".join([parts[i] for i in some]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), length)
                best, back = self.viterbi(codes)
                end, left = np.full(len(some), length), np.arange(len(some))
                while len(left):
                    found.append((some[left], end[left].copy(), best[left, end[left]]))
                    end[left] -= back[left, end[left]]
                    left = left[end[left] > 0]
        if not found:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        part, end, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        at = np.lexsort((end, part))
        part, end, ids = part[at], end[at], ids[at].astype(np.int32)
        owner = np.array(owner, dtype=np.int64)[part]
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):  # characters without a piece are written in bytes
            spelled = [self.piece_ids(parts[p][e - 1]) for p, e in zip(part[unknown].tolist(), end[unknown].tolist(), strict=True)]
            count = np.ones(len(ids), dtype=np.int64)
            count[unknown] = [len(x) for x in spelled]
            begin = np.cumsum(count) - count
            ids, owner = np.repeat(ids, count), np.repeat(owner, count)
            ids[np.concatenate([np.arange(b, b + len(x)) for b, x in zip(begin[unknown].tolist(), spelled, strict=True)])] = np.concatenate([np.array(x) for x in spelled])
        return ids, np.bincount(owner, minlength=len(words)).astype(np.int64)


class Encoder:
    """Encodes slices of texts; words that a task has met are looked up."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.cache = tk.IdCache(_CACHE_WORDS, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice and their bounds."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        filled = np.flatnonzero(np.diff(offsets))
        first = offsets[:-1][filled]
        space = data == 0x20
        starts = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        starts = np.setdiff1d(starts, first, assume_unique=True)
        begin = np.concatenate([first, starts])
        skip = np.concatenate([np.zeros(len(first), np.int64), np.ones(len(starts), np.int64)])
        order = np.argsort(begin, kind="stable")
        begin, skip = begin[order], skip[order]
        end = np.append(begin[1:], len(data))
        begin += skip
        row = np.searchsorted(offsets, begin - skip, "right") - 1
        hashes = tk.run_hashes(data, begin, end)

        def learn(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found = []
            for some in range(0, len(at), _WORDS_AT_ONCE):
                here = at[some : some + _WORDS_AT_ONCE]
                words = [_MARK + data[b:e].tobytes().decode("utf-8", "replace").replace(" ", _MARK) for b, e in zip(begin[here].tolist(), end[here].tolist(), strict=True)]
                found.append(self.model.encode_words(words))
            ids, lengths = zip(*found, strict=True)
            return np.concatenate(ids), np.concatenate(lengths)

        ids, length = self.cache.expand(hashes, learn)
        bounds = np.zeros(rows + 1, dtype=np.int64)
        np.cumsum(np.bincount(row, weights=length, minlength=rows).astype(np.int64), out=bounds[1:])
        return ids, bounds


_ENCODERS: dict[str, Encoder] = {}
tk.KEPT["pieces"] = _ENCODERS


def piece_encoder(path: str, shared) -> Encoder:
    """The encoder of a broadcast model; a worker process keeps it, and the words it has met, from task to task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(shared.value)
    return _ENCODERS[path]


def _plain(column: pa.Array) -> pa.Array:
    """Texts with the space mark itself read as a space."""
    import pyarrow.compute as pc

    return pc.replace_substring(pc.fill_null(column, ""), _MARK, " ")


def encode_texts(docs: DataFrame, model_path: str, decoded: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) for every row of docs(doc_id, text).

    With a name in `decoded`, a column of that name has the text that the ids decode to, as by `decode_ids`; the worker
    that wrote the ids reads them, where a step of its own would take a second worker for each task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(PieceModel(model_path))

    def encode(batches):
        encoder = piece_encoder(model_path, shared)
        for batch in batches:
            column = _plain(batch.column("text"))
            for first, n, data, offsets in tk.text_slices(column, _SLICE_BYTES):
                ids, bounds = encoder.encode(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n).cast(pa.int64()), lists], ["doc_id", "ids"])

    def both(batches):
        yield from _with_texts(encode(batches), shared.value.bytes, "ids", decoded)

    fields = "doc_id bigint, ids array<int>"
    if decoded is None:
        return docs.select("doc_id", "text").mapInArrow(tk.tidy(encode, "pieces"), fields)
    return docs.select("doc_id", "text").mapInArrow(tk.tidy(both, "pieces"), f"{fields}, `{decoded}` string")


def _with_texts(batches, pieces: list[bytes], ids: str, text: str):
    """The batches, in runs of rows, with the text of their ids as a further column."""
    sizes = np.array([len(x) for x in pieces], dtype=np.int64)
    begins, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(pieces), np.uint8)
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS_AT_ONCE):
            rows = batch.slice(first, _ROWS_AT_ONCE)
            part = rows.column(ids)
            count = np.array([0 if x is None else x for x in part.value_lengths().to_pylist()], dtype=np.int64)
            number = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            number = np.where((number >= 0) & (number < len(pieces)), number, 0)
            size = sizes[number]
            total = np.cumsum(size)
            data = flat[np.repeat(begins[number] - (total - size), size) + np.arange(total[-1] if len(total) else 0)].tobytes()
            ends = np.append(0, total)[np.append(0, np.cumsum(count))].tolist()
            texts = [data[b + (data[b : b + 1] == b" ") : max(b, e)].decode("utf-8", "replace") if e > b else "" for b, e in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*rows.schema.names, text])


def decode_ids(coded: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """coded with the text of its ids as a further column; ids outside the vocabulary count as unknown.

    A column named as the text is replaced.
    """
    from pyspark.sql.types import StringType, StructType

    coded = coded.drop(text)
    shared = coded.sparkSession.sparkContext.broadcast(PieceModel(model_path).bytes)

    def decode(batches):
        yield from _with_texts(batches, shared.value, ids, text)

    return coded.mapInArrow(tk.tidy(decode, "pieces"), StructType([*coded.schema.fields]).add(text, StringType()))
