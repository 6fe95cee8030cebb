"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

A token is a word (letters and digits, lower-cased, hashed to one of `WORDS` buckets), a word in capitals (one of
`CAPITALS` buckets), a word that repeats the one before it (`REPEATS` buckets) or one ASCII punctuation mark. Every token has a sparse random index vector; its word vector
adds up the index vectors of its neighbours over all documents of the corpus. A document's features are the means
of its tokens' word vectors and index vectors. Labels are learned from at most `SAMPLE` labelled documents, those
whose hashed id is smallest; a part of them is set aside to fit the temperature of the probabilities.

Defined results: a text without tokens (null, empty, only white space) has zero features and gets the network's
score for them. Rows are scored one by one, so repeated rows and ids each get theirs. An id that several rows
share is learned from the row with the smallest text hash. A document labelled more than once counts with its lowest label; null labels and ids are not learned from. Without any label every score
is 0.5. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .staging import staged, summed

WORDS, MARKS, CAPITALS, REPEATS = 4096, 128, 64, 64
VOCABULARY = WORDS + MARKS + CAPITALS + REPEATS
DIMENSIONS, NONZERO, WINDOW = 32, 4, 2
#: Most labelled documents that are learned from.
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 3e-3, 1e-4
_PIECES = 8
_ROWS_AT_ONCE = 256


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each token the places of its nonzero components, distinct, and their signs."""
    random = np.random.Generator(np.random.PCG64(1))
    places = np.argsort(random.random((VOCABULARY, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), random.choice(np.array([-1, 1]), (VOCABULARY, NONZERO)).astype(np.int64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a slice in text order, and their rows."""
    starts, ends, row = tk.runs(tk.ALNUM_BYTE[data], offsets)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = tk.run_hashes(data, starts, ends, lower=True)
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital = (ends - starts > 1) & (second >= 65) & (second <= 90)
    number = np.where(capital, WORDS + MARKS + (hashes % np.uint64(CAPITALS)).astype(np.int64), (hashes % np.uint64(WORDS)).astype(np.int64))
    repeat = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) + 1
    number[repeat] = WORDS + MARKS + CAPITALS + (hashes[repeat] % np.uint64(REPEATS)).astype(np.int64)
    marks = np.flatnonzero(tk.WORD_BYTE[data] & ~tk.ALNUM_BYTE[data])
    at = np.concatenate([starts, marks])
    order = np.argsort(at, kind="stable")
    number = np.concatenate([number, WORDS + data[marks].astype(np.int64)])[order]
    return number, np.searchsorted(offsets, at[order], "right") - 1


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors and index vectors, a row for each token; learned from all documents."""
    places, signs = index_vectors()

    def count(batches):
        total = np.zeros(VOCABULARY * DIMENSIONS)
        for batch in batches:
            for _, _, data, offsets in tk.text_slices(batch.column(0)):
                number, row = tokens(data, offsets)
                for k in range(1, WINDOW + 1):
                    if len(number) <= k:
                        continue
                    near = row[k:] == row[:-k]
                    left, right = number[:-k][near], number[k:][near]
                    for mine, other in ((left, right), (right, left)):
                        for j in range(NONZERO):
                            total += np.bincount(mine * DIMENSIONS + places[other, j], weights=signs[other, j], minlength=len(total))
        piece = np.rint(total).astype(np.int64).reshape(_PIECES, -1)
        source = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(_PIECES), pa.int32()), pa.array([source] * _PIECES, pa.int32()), pa.array([x.tobytes() for x in piece], pa.binary())], ["piece", "source", "values"])

    rows = summed(docs.select("text").mapInArrow(tk.tidy(count), "piece int, source int, values binary")).collect()
    context = np.zeros((VOCABULARY, DIMENSIONS))
    if rows:
        context = np.concatenate([np.frombuffer(x["values"], np.int64) for x in sorted(rows, key=lambda x: x["piece"])]).reshape(VOCABULARY, DIMENSIONS).astype(np.float64)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1.0)
    own = np.zeros((VOCABULARY, DIMENSIONS))
    np.put_along_axis(own, places, signs, axis=1)
    return np.concatenate([context, own], axis=1)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of the texts' tokens and the logarithm of their number, a row for each text."""
    out = []
    for _, n, data, offsets in tk.text_slices(column):
        number, row = tokens(data, offsets)
        for first in range(0, n, _ROWS_AT_ONCE):
            rows = min(_ROWS_AT_ONCE, n - first)
            begin, end = np.searchsorted(row, [first, first + rows])
            counts = np.bincount((row[begin:end] - first) * VOCABULARY + number[begin:end], minlength=rows * VOCABULARY).reshape(rows, VOCABULARY)
            total = counts.sum(axis=1, keepdims=True)
            out.append(np.concatenate([counts @ vectors / np.maximum(total, 1), np.log1p(total)], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2 * DIMENSIONS + 1))


@dataclass
class Network:
    """Weights of the two layers, the features' scale and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        return np.tanh((features - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -60, 60)))


def fit_network(features: np.ndarray, labels: np.ndarray, seed: int = 1) -> Network:
    """Trains on four fifths of the rows by Adam and fits the temperature on the rest."""
    random = np.random.Generator(np.random.PCG64(seed))
    d = features.shape[1]
    if not len(labels):
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)
    order = random.permutation(len(labels))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    mean, scale = features[train].mean(axis=0), np.maximum(features[train].std(axis=0), 1e-3)
    x, y = (features[train] - mean) / scale, labels[train].astype(np.float64)
    p = [random.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for _ in range(EPOCHS):
        shuffled = random.permutation(len(y))
        for begin in range(0, len(y), BATCH):
            at = shuffled[begin : begin + BATCH]
            hidden = np.tanh(x[at] @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3][0], -60, 60))) - y[at]) / len(at)
            back = np.outer(error, p[2]) * (1 - hidden**2)
            grads = [x[at].T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ error + DECAY * p[2], np.array([error.sum()])]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if len(held):
        logits, truth = network.logits(features[held]), labels[held]
        loss = lambda t: float(np.logaddexp(0, np.where(truth > 0, -logits, logits) / t).mean())
        network.temperature = min(np.exp(np.linspace(np.log(0.5), np.log(10), 60)), key=loss)
    return network


def train_classifier(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of docs(doc_id, text) and a network for labels(doc_id, label 0 or 1)."""
    spark = docs.sparkSession
    vectors = word_vectors(docs)
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow()
    if not chosen.num_rows:
        return vectors, fit_network(np.zeros((0, 2 * DIMENSIONS + 1)), np.zeros(0))
    shared = spark.sparkContext.broadcast(vectors)

    def features(batches):
        for batch in batches:
            found = pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("place"), pa.array(list(found.astype(np.float64).reshape(len(found), -1)), pa.list_(pa.float64()))], ["doc_id", "label", "place", "features"])

    few = F.broadcast(spark.createDataFrame(chosen.to_pandas()[["doc_id", "label"]]).selectExpr("cast(doc_id as bigint) doc_id", "cast(label as int) label"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(few, "doc_id").select("doc_id", "label", F.xxhash64("text").alias("place"), "text")
    rows = texts.mapInArrow(tk.tidy(features), "doc_id bigint, label int, place bigint, features array<double>")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("place", "label", "features")).alias("x")).select("doc_id", "x.label", "x.features").toArrow().sort_by("doc_id")
    table = np.array(rows.column("features").to_pylist(), dtype=np.float64).reshape(rows.num_rows, 2 * DIMENSIONS + 1)
    return vectors, fit_network(table, (rows.column("label").to_numpy() > 0).astype(np.float64))


def with_scores(docs: DataFrame, vectors: np.ndarray, network: Network, name: str = "score") -> DataFrame:
    """docs with the probability of label 1 as a further column; a column of that name is replaced."""
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def score(batches):
        for batch in batches:
            table, net = shared.value
            found = net.probabilities(pooled(batch.column("text"), table))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(tk.tidy(score), StructType([*docs.schema.fields]).add(name, DoubleType()))


def in_fold(doc_id, remainder: int):
    """Whether crc32 of the id as text leaves this remainder modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == remainder, F.lit(False))


def classify_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs(doc_id, text); labels(doc_id, quality).

    Rows whose crc32 remainder is 1 are held out: their labels are never read for learning.
    """
    learn = labels.where(~in_fold(F.col("doc_id"), 1)).select("doc_id", F.col("quality").alias("label"))
    vectors, network = train_classifier(docs, learn, sample)
    scored = with_scores(docs.select("doc_id", "text"), vectors, network, "score")
    return scored.select("doc_id", in_fold(F.col("doc_id"), 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
