"""Approximate nearest neighbours: inverted lists scanned with adaptive dimension sampling.

Centroids come from k-means over a bounded sample; every vector is put into the list of its nearest centroid,
rotated by a fixed random orthogonal matrix. Queries visit the lists whose centroids are nearest; how many is fitted
on the sample so that at least `RECALL` of the neighbours lie in them, and a query whose lists hold few rows goes on
to further ones until they hold `ENOUGH` times k, or all rows. Within a list, rotated vectors are read in
blocks of columns: a candidate is given up as soon as its partial distance, scaled by the share of dimensions read,
exceeds the current tenth distance by more than chance allows. What is left is measured on the original vectors in
double precision.

Lists are cut into pieces of a fixed size by row, and so are the queries that visit a piece, so a vector or an id
that a third of all rows hold fills more pieces, not a larger one.

Defined results: rows whose vector is null, all zeros, of another length than most, or holds null or non-finite
components take no part, nor do rows with a null vec_id. Ties go to the smaller vec_id. Rows that repeat a vec_id
are queries and candidates of their own: only a query's own row is not among its candidates. A query with fewer than
k candidates gets all of them. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

K = 10
#: Most rows that centroids, rotation and the number of visited lists are fitted on.
SAMPLE = 16_384
RECALL = 0.97
BLOCK = 16
SIGNIFICANCE = 2.1
MOST_LISTS = 4096
#: How many times k rows the lists that a query visits hold at least.
ENOUGH = 8
#: Vectors in a piece of a list, and queries that meet a piece at once.
PIECE_ROWS = 16_384


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def kmeans(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Centroids after some rounds from evenly spaced sample rows; empty ones stay where they are."""
    centroids = sample[np.linspace(0, len(sample) - 1, lists).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([_squares(sample[i : i + 4096], centroids).argmin(1) for i in range(0, len(sample), 4096)])
        counts = np.bincount(nearest, minlength=lists)
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, sample)
        centroids[counts > 0] = total[counts > 0] / counts[counts > 0, None]
    return centroids


def lists_to_visit(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float, queries: int = 256) -> int:
    """The least number of lists that holds this share of the sample's own neighbours."""
    nearest = np.concatenate([_squares(sample[i : i + 4096], centroids).argmin(1) for i in range(0, len(sample), 4096)])
    at = np.unique(np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int))
    distances = _squares(sample[at], sample)
    distances[np.arange(len(at)), at] = np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(centroids)
    found = np.argpartition(distances, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(_squares(sample[at], centroids), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, nearest[found], axis=1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1


def scan(query: np.ndarray, rotated_query: np.ndarray, vectors: np.ndarray, rotated: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a piece's rows: vec_ids and exact distances, nearest first, ties to the smaller id; `own` marks the query's row."""
    d = rotated.shape[1]
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    allowed = np.flatnonzero(~own)
    for begin in range(0, len(allowed), 256):
        rows = allowed[begin : begin + 256]
        if len(best) == k:
            limit = best[-1] ** 2
            partial = np.zeros(len(rows))
            for at in range(0, d, BLOCK):
                part = rotated[rows, at : at + BLOCK] - rotated_query[at : at + BLOCK]
                partial += np.einsum("ij,ij->i", part, part)
                read = min(at + BLOCK, d)
                slack = (1 + SIGNIFICANCE / math.sqrt(read)) ** 2 if read < d else 1 + 1e-6
                stay = partial <= limit * (read / d) * slack + 1e-12
                rows, partial = rows[stay], partial[stay]
                if not len(rows):
                    break
        if not len(rows):
            continue
        exact = np.sqrt(np.square(vectors[rows] - query).sum(axis=1))
        all_ids, all_found = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, exact])
        order = np.lexsort((all_ids, all_found))[:k]
        best_ids, best = all_ids[order], all_found[order]
    return best_ids, best


def nearest_neighbours(vectors: DataFrame, is_query, k: int = K, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows of vectors(vec_id, vector) where is_query holds."""
    spark = vectors.sparkSession
    numbers = F.col("vector").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), numbers.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(F.coalesce(finite, F.lit(False)))
    widths = usable.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(2).collect()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if not widths:
        return spark.createDataFrame([], out)
    d, n = widths[0]["d"], widths[0]["count"]
    usable = usable.where(F.size("vector") == d)
    few = usable.select("vector", F.monotonically_increasing_id().alias("row")).orderBy(F.xxhash64("row"), "row").limit(sample).select("vector").toArrow()
    points = np.array(few.column("vector").to_pylist(), dtype=np.float64)
    lists = max(1, min(MOST_LISTS, round(math.sqrt(n) / 2), len(points) // 8 or 1))
    centroids = kmeans(points, lists)
    visits = min(lists, lists_to_visit(points, centroids, k, recall))
    rotation = np.linalg.qr(np.random.Generator(np.random.PCG64(7)).normal(size=(d, d)))[0]
    shared = spark.sparkContext.broadcast((centroids, rotation))

    def assign(batches):
        middle, turn = shared.value
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)
            near = _squares(x, middle).argmin(1).astype(np.int32) if len(x) else np.zeros(0, np.int32)
            rows = [r.tobytes() for r in x]
            turned = [r.tobytes() for r in (x @ turn).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), pa.array(near), pa.array(rows, pa.binary()), pa.array(turned, pa.binary()), batch.column("is_query")], ["row", "vec_id", "list", "vector", "rotated", "is_query"])

    rows = usable.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector", "is_query")
    index = staged(rows.mapInArrow(assign, "row bigint, vec_id bigint, list int, vector binary, rotated binary, is_query boolean"), "lists")
    sizes = np.zeros(lists, np.int64)  # as many counts as lists, at most MOST_LISTS
    for x in index.groupBy("list").count().collect():
        sizes[x["list"]] = x["count"]

    def route(batches):
        middle, _ = shared.value
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float64).reshape(batch.num_rows, d)
            order = np.argsort(_squares(x, middle), axis=1, kind="stable").astype(np.int32)
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            wanted = (np.arange(lists) < visits) | (before < ENOUGH * k + 1)
            near = [row[keep] for row, keep in zip(order, wanted, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.list_(pa.int32()))], [*batch.schema.names, "lists"])

    asked = index.where("is_query").select("row", "vec_id", "vector", "rotated").mapInArrow(route, "row bigint, vec_id bigint, vector binary, rotated binary, lists array<int>")
    asked = staged(asked.select("row", "vec_id", "vector", "rotated", F.explode("lists").alias("list")), "asked")
    share = lambda table, name: table.groupBy("list").agg(F.ceil(F.count("*") / PIECE_ROWS).cast("int").alias(name))
    shares = F.broadcast(share(index, "pieces").join(share(asked, "turns"), "list"))
    dealt = lambda by: F.pmod(F.xxhash64("row"), F.col(by)).cast("int")
    left = index.join(shares, "list").select("list", dealt("pieces").alias("piece"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "row", "vec_id", "vector", "rotated")
    right = asked.join(shares, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), dealt("turns").alias("turn"), "row", "vec_id", "vector", "rotated")

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and queries.num_rows:
            stack = lambda t, c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(t.num_rows, d)
            x, turned, ids, places = stack(rows, "vector", np.float64), stack(rows, "rotated", np.float32).astype(np.float64), rows.column("vec_id").to_numpy(), rows.column("row").to_numpy()
            q, turned_q, own, own_id = stack(queries, "vector", np.float64), stack(queries, "rotated", np.float32).astype(np.float64), queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
            for i in range(len(q)):
                near, score = scan(q[i], turned_q[i], x, turned, ids, places == own[i], k)
                found.append((np.full(len(near), own[i]), np.full(len(near), own_id[i]), near, score))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table(dict(zip(("query", "query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    keys = ["list", "piece", "turn"]
    merged = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query bigint, query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id")).alias("rank")
    return merged.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
