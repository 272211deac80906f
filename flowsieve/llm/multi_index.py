"""Approximate nearest neighbours by largest inner product over an inverted multi-index.

The two halves of the vectors are quantised separately; a vector lies in the cell of its pair of
centroids. A query visits pairs in order of their summed score (the inner products of its halves
with the centroids) with a heap, and stops when the vectors not yet visited are expected to hold
fewer than ``missed`` of its neighbours. The entries of the visited cells are reranked exactly.

Spark holds the index: rows (unit, block) of packed vectors, a unit being the cells of one first
centroid, cut into blocks of bounded size. Queries travel in bundles to the units they visit, and a
task multiplies one bundle with one block. Only codebooks, the number of vectors per cell and a
bounded sample, all of sizes fixed by parameters, go through the driver.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import stored

SAMPLE = 16_384
CENTROIDS = 1024
PER_CELL = 32
BLOCK = 4096
BUNDLE = 256
MISSED = 1.0
ROUNDS = 12
NEAR = 1e-9


def usable(vectors: DataFrame, column: str, key: str) -> DataFrame:
    """id and vector (double) of the rows that take part: a key, and a vector of the table's most
    common length without null or non-finite components that is not all zero."""
    kept = vectors.select(
        F.col(key).cast("bigint").alias("id"), F.col(column).cast("array<double>").alias("vector")
    ).filter(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    length = kept.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.filter(F.size("vector") == (length["n"] if length else 0))


def folded(rows: DataFrame, top: int) -> DataFrame:
    """Of equal vectors the ``top`` + 1 smallest ids: no query can have use for more."""
    same = Window.partitionBy("vector").orderBy("id")
    return rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= top + 1).drop("_n")


def codebook(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's k-means from distinct seeded points; a centroid left without points stays."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(ROUNDS):
        near = nearest(points, centres)
        n = np.bincount(near, minlength=len(centres))
        for d in range(points.shape[1]):
            total = np.bincount(near, points[:, d], len(centres))
            centres[n > 0, d] = total[n > 0] / n[n > 0]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * points @ centres.T).argmin(1)


@dataclass
class MultiIndex:
    """Two codebooks, the vectors per cell, and the sample that calibrates where to stop."""

    first: np.ndarray
    second: np.ndarray
    cells: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    missed: float = MISSED
    sample_cells: tuple = ()

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cell_of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            nearest(points[:, : self.half], self.first),
            nearest(points[:, self.half :], self.second),
        )

    def blocks(self, unit: int) -> int:
        """Blocks of a unit, of about ``BLOCK`` vectors each."""
        return max(1, -(-int(self.cells[unit].sum()) // BLOCK))

    def stopping(self, ids: np.ndarray, queries: np.ndarray, top: int):
        """Per query: scores of the sample, an estimate of the top-th score in the whole index, and
        the spread of scores round their cells'. The estimate is the top-th score in the sample,
        carried on by the mean excess of the sample's tail to the number of vectors."""
        i, j = self.sample_cells
        scores = queries @ self.sample.T
        centre = queries[:, : self.half] @ self.first.T[:, i] + queries[:, self.half :] @ self.second.T[:, j]
        spread = np.maximum((scores - centre).std(axis=1), 1e-9)
        scores[ids[:, None] == self.sample_ids[None, :]] = -np.inf
        if scores.shape[1] <= top + 1:
            return scores, np.full(len(ids), -np.inf), spread
        tail = min(3 * top, scores.shape[1] - 2)
        high = -np.sort(-scores, axis=1)[:, : tail + 1]
        excess = np.maximum((high[:, :tail] - high[:, tail : tail + 1]).mean(axis=1), 0.0)
        growth = math.log(max(self.cells.sum() / scores.shape[1], 1.0))
        return scores, high[:, top - 1] + 0.8 * excess * growth, spread

    def floor(self, scores: np.ndarray, visited: list[tuple[int, int]], top: int) -> float:
        """The top-th score of the sample's vectors in the visited cells: as these are entries, no
        entry below it is among a query's best."""
        mask = np.zeros(self.cells.shape, bool)
        mask[tuple(np.array(visited, np.int64).reshape(-1, 2).T)] = True
        inside = scores[mask[self.sample_cells]]
        return float(np.partition(inside, -top)[-top]) if len(inside) > top else -math.inf

    def visit(self, query: np.ndarray, wanted: float, spread: float, top: int) -> list[tuple[int, int]]:
        """Cells in order of summed score, by the multi-sequence walk over two sorted lists, until
        those left are expected to hold fewer than ``missed`` of the best (and, at any rate, until
        more than ``top`` vectors are in)."""
        a, b = self.first @ query[: self.half], self.second @ query[self.half :]
        by_a, by_b = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        sa, sb = a[by_a].tolist(), b[by_b].tolist()
        heap, pushed = [(-(sa[0] + sb[0]), 0, 0)], {(0, 0)}
        total = left = int(self.cells.sum())
        visited: list[tuple[int, int]] = []
        by_a, by_b, cells = by_a.tolist(), by_b.tolist(), self.cells
        while heap and left:
            score, x, y = heapq.heappop(heap)
            likely = 0.5 * math.erfc((wanted + score) / spread / math.sqrt(2))
            if total - left > top and wanted > -math.inf and left * likely <= self.missed:
                break
            n = int(cells[by_a[x], by_b[y]])
            if n:
                visited.append((by_a[x], by_b[y]))
                left -= n
            for u, v in ((x + 1, y), (x, y + 1)):
                if u < len(sa) and v < len(sb) and (u, v) not in pushed:
                    pushed.add((u, v))
                    heapq.heappush(heap, (-(sa[u] + sb[v]), u, v))
        return visited


def _as_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _assigner(shared):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if batch.num_rows:
                i, j = index.cell_of(_as_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))],
                    ["id", "vector", "unit", "second"],
                )

    return assign


def build(rows: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS, missed: float = MISSED):
    """The index of ``rows`` (id, vector): the model and the stored rows with their cells.

    Codebooks are fitted on the ``sample`` rows first by a hash of their id; every row is indexed.
    The number of centroids a half follows the root of the number of rows, up to ``centroids``.
    """
    n = rows.count()
    if not n:
        return None, None
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    points = np.array(taken.vector.tolist(), np.float64)
    half = max(1, points.shape[1] // 2)
    k = max(2, min(centroids, round(math.sqrt(n / PER_CELL))))
    index = MultiIndex(
        codebook(points[:, :half], k, 1), codebook(points[:, half:], k, 2),
        np.zeros((0, 0)), taken.id.to_numpy(np.int64), points, missed,
    )
    index.sample_cells = index.cell_of(points)
    context = rows.sparkSession.sparkContext
    schema = "id bigint, vector array<double>, unit int, second int"
    placed = stored(rows.mapInArrow(_assigner(context.broadcast(index)), schema), "cells")
    counts = placed.groupBy("unit", "second").count().toPandas()
    index.cells = np.zeros((len(index.first), len(index.second)), np.int64)
    index.cells[counts.unit, counts.second] = counts["count"]
    return index, placed


def packed_blocks(index: MultiIndex, placed: DataFrame) -> DataFrame:
    """unit, block, entries (id, second, vector): at most about ``BLOCK`` entries a row."""
    counts = F.array(*[F.lit(index.blocks(u)) for u in range(len(index.first))])
    block = F.pmod(F.xxhash64("id"), F.get(counts, F.col("unit"))).cast("int").alias("block")
    return placed.groupBy("unit", block).agg(
        F.collect_list(F.struct("id", "second", "vector")).alias("entries")
    )


def _bundler(shared, top: int):
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BUNDLE):
                part = batch.slice(at, BUNDLE)
                ids, queries = part.column(0).to_numpy(), _as_matrix(part.column(1))
                scores, wanted, spread = index.stopping(ids, queries, top)
                by_unit: dict[int, list] = {}
                for q in range(len(ids)):
                    seconds: dict[int, list[int]] = {}
                    visited = index.visit(queries[q], wanted[q], spread[q], top)
                    floor = index.floor(scores[q], visited, top)
                    for i, j in visited:
                        seconds.setdefault(i, []).append(j)
                    for i, js in seconds.items():
                        by_unit.setdefault(i, []).append(
                            {"id": ids[q], "floor": floor, "seconds": js, "vector": queries[q]}
                        )
                rows = [(u, b, qs) for u, qs in by_unit.items() for b in range(index.blocks(u))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2] for r in rows], _QUERIES),
                    ],
                    ["unit", "block", "queries"],
                )

    return bundle


_QUERIES = pa.list_(
    pa.struct(
        [("id", pa.int64()), ("floor", pa.float64()), ("seconds", pa.list_(pa.int32())), ("vector", pa.list_(pa.float64()))]
    )
)
_QUERIES_DDL = "array<struct<id:bigint,floor:double,seconds:array<int>,vector:array<double>>>"


def _reranker(seconds: int, top: int):
    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                entries = batch.column(0).slice(r, 1).flatten()
                queries = batch.column(1).slice(r, 1).flatten()
                yield from _best_of_block(entries, queries, seconds, top)

    return rerank


def _best_of_block(entries, queries, seconds: int, top: int):
    """The top entries of one block for each query of one bundle, among the cells it visits."""
    ids, second = entries.field(0).to_numpy(), entries.field(1).to_numpy()
    vectors, wanted = _as_matrix(entries.field(2)), _as_matrix(queries.field(3))
    keys, floors = queries.field(0).to_numpy(), queries.field(1).to_numpy()
    visited = np.zeros((len(keys), seconds), bool)
    lists = queries.field(2)
    lengths = np.diff(lists.offsets.to_numpy())
    visited[np.repeat(np.arange(len(keys)), lengths), lists.flatten().to_numpy()] = True
    scores = wanted @ vectors.T
    scores[~visited[:, second] | (keys[:, None] == ids[None, :])] = -np.inf
    if scores.shape[1] > top:
        least = np.partition(scores, -top, axis=1)[:, -top]
    else:
        least = np.full(len(keys), -np.inf)
    # Ties within rounding stay in until scores are summed in one fixed order.
    q, e = np.nonzero((scores >= np.maximum(least, floors)[:, None] - NEAR) & np.isfinite(scores))
    exact = np.add.reduce(wanted[q] * vectors[e], axis=1) if len(q) else np.zeros(0)
    order = np.lexsort((ids[e], -exact, q))
    q, e, exact = q[order], e[order], exact[order]
    starts = np.searchsorted(q, q)
    kept = np.arange(len(q)) - starts < top
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys[q[kept]]), pa.array(ids[e[kept]]), pa.array(exact[kept])],
        ["query_id", "id", "score"],
    )


def search(queries: DataFrame, index: MultiIndex, placed: DataFrame, top: int) -> DataFrame:
    """query_id, rank (from 1), id, score of the ``top`` nearest found, ties to the smaller id.

    ``queries`` has id and vector. A query is not its own neighbour. A block yields at most ``top``
    entries a query, and none below the query's proven floor.
    """
    context = queries.sparkSession.sparkContext
    bundles = queries.mapInArrow(
        _bundler(context.broadcast(index), top), f"unit int, block int, queries {_QUERIES_DDL}"
    )
    met = packed_blocks(index, placed).join(bundles, ["unit", "block"]).select("entries", "queries")
    found = met.mapInArrow(
        _reranker(len(index.second), top), "query_id bigint, id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def nearest_neighbours(
    vectors: DataFrame,
    is_query,
    top: int = 20,
    column: str = "embedding",
    key: str = "vec_id",
    **options,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` largest inner products found for each row that
    meets ``is_query`` (a condition on ``id``), against all other rows.

    Rows with a null key, or a null, zero, non-finite, incomplete or odd-length vector, take no
    part. Rows that repeat a key are one item, with the smallest of their vectors. An empty table gives
    an empty table.
    """
    rows = stored(usable(vectors, column, key).groupBy("id").agg(F.min("vector").alias("vector")), "vectors")
    index, placed = build(folded(rows, top), **options)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if index is None:
        return vectors.sparkSession.createDataFrame([], schema)
    queries = rows.filter(is_query)
    queries = queries.repartition(max(1, -(-queries.count() // BUNDLE)), "id")
    found = search(queries, index, placed, top)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
