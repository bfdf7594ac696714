"""Approximate nearest neighbours by cosine with an inverted multi-index.

1. Vectors are scaled to length 1 and cut into two halves. Each half has a
   codebook of ``centroids`` centroids, fitted by k-means on a bounded
   sample (the ``sample_rows`` rows with the smallest hash).
2. Every vector goes into the cell of its two nearest centroids: the index
   has ``centroids ** 2`` cells and every row.
3. A query walks the pairs of centroids by the sum of its two distances: a
   heap holds the next pair of each started row of the grid. It stops once
   the cells it has seen hold ``reach`` of all vectors.
4. Queries meet the entries of their cells in blocks and the entries are
   reranked by their exact cosine in double precision.

Blocks: cells are grouped by their first centroid, and both sides of a group
are dealt into pieces of about ``block`` rows, so that a cell with a third
of all vectors is many blocks, not one task's. Of equal vectors only the k+1
with the smallest ids can be among k nearest; the others are left out before
the index is searched, by a limit that each task applies before the shuffle.

How far a query must reach depends on the vectors: on vectors without
clusters the nearest ones lie in many cells. See README for the recall.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored


def _unit(rows: list) -> np.ndarray:
    x = np.array([np.asarray(r, float) for r in rows])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_codebook(x: np.ndarray, centroids: int, rounds: int = 12, seed: int = 6) -> np.ndarray:
    """k-means; fewer rows than centroids give one centroid each."""
    rng = np.random.default_rng(seed)
    book = x[rng.choice(len(x), min(centroids, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(x, book).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, x)
        book[count > 0] = sums[count > 0] / count[count > 0, None]
    return book


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centroid."""
    return (x * x).sum(axis=1)[:, None] + (book * book).sum(axis=1)[None, :] - 2 * x @ book.T


def walk_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Pairs (i, j) by growing ``first[i] + second[j]`` until their ``sizes`` add up to ``enough``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    out, seen = [], 0
    while heap and seen < enough:
        _, i, j = heapq.heappop(heap)
        if sizes[a[i], b[j]]:
            out.append((int(a[i]), int(b[j])))
            seen += int(sizes[a[i], b[j]])
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return out


def _assign(books: tuple[np.ndarray, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _unit(b.column(1).to_pylist())
            half = books[0].shape[1]
            cells = [_distances(part, book).argmin(axis=1).astype(np.int32)
                     for part, book in zip((x[:, :half], x[:, half:]), books)]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, cells)], ["vec_id", "vector", "c1", "c2"])
    return run


def _probe(books: tuple[np.ndarray, np.ndarray], sizes: np.ndarray, enough: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for query, vector in zip(b.column(0).to_pylist(), b.column(1)):
                x = _unit([vector.as_py()])
                half = books[0].shape[1]
                cells: dict[int, list[int]] = {}
                for i, j in walk_cells(_distances(x[:, :half], books[0])[0], _distances(x[:, half:], books[1])[0], sizes, enough):
                    cells.setdefault(i, []).append(j)
                n = len(cells)
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array([query] * n, pa.int64()), "query": pa.array([vector.as_py()] * n, pa.list_(pa.float64())),
                    "c1": pa.array(list(cells), pa.int32()), "cells": pa.array(list(cells.values()), pa.list_(pa.int32()))})
    return run


def _rerank(k: int, width: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(entries):
            raw_q, raw_e = np.array(queries["query"].tolist(), float), np.array(entries["vector"].tolist(), float)
            norm_q, norm_e = np.sqrt((raw_q * raw_q).sum(axis=1)), np.sqrt((raw_e * raw_e).sum(axis=1))
            near = (raw_q / norm_q[:, None]) @ (raw_e / norm_e[:, None]).T
            probed = np.zeros((len(queries), width), bool)
            for row, cells in enumerate(queries["cells"]):
                probed[row, cells] = True
            ids, asked = entries["vec_id"].to_numpy(np.int64), queries["query_id"].to_numpy(np.int64)
            near[~probed[:, entries["c2"].to_numpy()] | (ids[None, :] == asked[:, None])] = -np.inf
            for row in range(len(queries)):
                scores = near[row]
                least = -np.partition(-scores, k - 1)[k - 1] if len(scores) > k else -np.inf
                # all that rounding could put among the k
                for i in np.flatnonzero((scores >= least - 1e-9) & (scores > -np.inf)):
                    out.append((asked[row], ids[i], float((raw_q[row] * raw_e[i]).sum() / (norm_q[row] * norm_e[i]))))
            out = [x for _, group in _by_query(out) for x in sorted(group, key=lambda r: (-r[2], r[1]))[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    return run


def _by_query(rows: list[tuple]):
    groups: dict[int, list[tuple]] = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups.items()


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
                       centroids: int = 64, reach: float = 0.5, sample_rows: int = 20000, block: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest found for every row of ``queries``.

    Candidates are all rows of ``vectors`` but the query's own id; nearest
    first, ties to the smaller id; all candidates, if there are fewer.
    ``score`` is the cosine of the original vectors in double precision.

    * Vectors that are null, empty or zero, or that hold a null or
      non-finite component, take no part on either side; neither do null
      ids, nor vectors whose length is not the most frequent one.
    * Rows that repeat an id and a vector count once; an id with several
      vectors is a candidate with each, and given once, with the best.
    * No vectors or no queries give an empty result. Extra columns are
      ignored, whatever their names.

    The sample (``sample_rows`` vectors), the codebooks and the cell counts
    come to the driver: bounded by parameters.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("vector")
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
        return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
                .filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(good, F.lit(False))))

    rows = usable(vectors)
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    same_length = F.size("vector") == lengths[0]["n"]
    first_ids = Window.partitionBy("vector").orderBy("vec_id")
    entries = (rows.filter(same_length).distinct().withColumn("copy", F.row_number().over(first_ids))
               .filter(F.col("copy") <= k + 1).drop("copy"))
    sample = entries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").collect()
    x = _unit([r["vector"] for r in sample])
    half = max(1, x.shape[1] // 2)
    books = (fit_codebook(x[:, :half], centroids), fit_codebook(x[:, half:], centroids))
    index = stored(entries.mapInArrow(_assign(books), "vec_id long, vector array<double>, c1 int, c2 int"), "multi-index")
    sizes = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in index.groupBy("c1", "c2").count().collect():  # at most centroids ** 2 cells
        sizes[r["c1"], r["c2"]] = r["count"]
    enough = int(np.ceil(reach * sizes.sum()))
    asked = usable(queries).filter(same_length).distinct()
    probes = stored(asked.mapInArrow(_probe(books, sizes, max(enough, k + 1)),
                                     "query_id long, query array<double>, c1 int, cells array<int>"), "probes")
    counts = {r["c1"]: r["count"] for r in probes.groupBy("c1").count().collect()}
    pieces = spark.createDataFrame([(i, int(-(-int(sizes[i].sum()) // block)) or 1, -(-counts.get(i, 0) // block) or 1)
                                    for i in range(len(books[0]))], "group int, e_pieces int, q_pieces int")
    # one row per centroid is broadcast
    e = index.join(F.broadcast(pieces), F.col("c1") == F.col("group")).select(
        "c1", F.pmod(F.xxhash64("vec_id"), "e_pieces").cast("int").alias("e_piece"),
        F.explode(F.sequence(F.lit(0), F.col("q_pieces") - 1)).alias("q_piece"), "vec_id", "vector", "c2")
    q = probes.join(F.broadcast(pieces), F.col("c1") == F.col("group")).select(
        "c1", F.explode(F.sequence(F.lit(0), F.col("e_pieces") - 1)).alias("e_piece"),
        F.pmod(F.xxhash64("query_id"), "q_pieces").cast("int").alias("q_piece"), "query_id", "query", "cells")
    key = ("c1", "e_piece", "q_piece")
    found = q.groupBy(*key).cogroup(e.groupBy(*key)).applyInPandas(_rerank(k, sizes.shape[1]), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
