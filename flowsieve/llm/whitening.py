"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Spark folds the rows into exact sums and one centred scatter matrix: every task merges centred
batches into one (count, sums, scatter), and those partial results are merged round the common
mean. The matrix has the size of the vectors, whatever the number of rows, and is factored on the
driver: A = P L L' P' by Cholesky with pivoting, then plane rotations make the columns of L
orthogonal. Their squared norms are the eigenvalues of A, the columns themselves, made unit
length, its eigenvectors; A is never iterated on, so small eigenvalues keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import stored

COMPONENTS = 32
# Fixed: the integer grid of the contract.
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**62 / SCALE
SWEEPS = 60


def grid_vectors(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id and x, the vector as integers floor(64 c) + 1000000, of the rows that take part.

    Left out are null vectors, empty ones, those with a null or non-finite entry or one whose
    integer needs more than 62 bits, and those of another length than most have (ties: the
    shortest). A null key stays: it is a row like any other.
    """
    kept = vectors.select(
        F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("v")
    ).filter(
        F.col("v").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    )
    length = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    x = F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT))
    return kept.filter(F.size("v") == (length["n"] if length else 0)).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _scatter(values: np.ndarray, sums: list[int]) -> np.ndarray:
    """Scatter of integer rows round their own mean, centred before multiplying."""
    y = _times_minus(len(values), values, sums).astype(np.float64) / len(values)
    return y.T @ y


def _times_minus(n: int, x: np.ndarray, sums: list[int]) -> np.ndarray:
    """n x - S exactly: in 64-bit integers where these hold it, else in Python's."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 2**63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _exact_sums(x: np.ndarray) -> list[int]:
    """Column sums without overflow: of the upper and lower halves of the 64-bit integers."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(b) for h, b in zip(high, low)]


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: count, sums in two halves, and the scatter round the task's own mean."""
    n, sums, scatter = 0, None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            x = _matrix(batch.column(0).slice(at, 2048))
            own = _exact_sums(x)
            part = _scatter(x, own)
            if sums is None:
                n, sums, scatter = len(x), own, part
                continue
            gap = np.array([a / n - b / len(x) for a, b in zip(sums, own)])
            scatter += part + np.outer(gap, gap) * (n * len(x) / (n + len(x)))
            n, sums = n + len(x), [a + b for a, b in zip(sums, own)]
    if n:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n], pa.int64()),
                pa.array([[s >> 32 for s in sums]], pa.list_(pa.int64())),
                pa.array([[s & 0xFFFFFFFF for s in sums]], pa.list_(pa.int64())),
                pa.array([scatter.ravel()], pa.list_(pa.float64())),
            ],
            ["n", "high", "low", "scatter"],
        )


def _summed(frame: DataFrame, column: str, kind: str) -> list:
    """Element-wise sums of arrays, in order; as many numbers as one array has."""
    rows = frame.select(F.posexplode(column)).groupBy("pos").agg(F.sum(F.col("col").cast(kind)).alias("v"))
    return [r["v"] for r in rows.orderBy("pos").collect()]


def _around(mean: np.ndarray):
    """Partial scatters round ``mean``, added up over a task."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            counts, scatters = batch.column(0).to_numpy(), _matrix(batch.column(2))
            for n, own, scatter in zip(counts, batch.column(1).to_pylist(), scatters):
                gap = np.array(own) - mean
                part = scatter + n * np.outer(gap, gap).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["scatter"])

    return merge


def _merged_scatter(partials: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The scatter of all rows from (n, mean, scatter) of groups of them."""
    rows = partials.mapInArrow(_around(mean), "scatter array<double>")
    return np.array(_summed(rows, "scatter", "double")).reshape(len(mean), len(mean))


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L and the order of pivots with a[order][:, order] = L L'; L has as many columns as ``a`` has
    rank: it ends where what is left of the diagonal is rounding."""
    a, d = a.copy(), len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * a.diagonal().max(initial=0.0)
    for k in range(d):
        p = k + int(a.diagonal()[k:].argmax())
        if a[p, p] <= least:
            return factor[:, :k], order
        if p != k:
            a[[k, p]], order[[k, p]], factor[[k, p]] = a[[p, k]], order[[p, k]], factor[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
        factor[k:, k] = a[k:, k] / np.sqrt(a[k, k])
        a[k:, k:] -= np.outer(factor[k:, k], factor[k:, k])
    return factor, order


def jacobi_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated in pairs until all are orthogonal.

    A sweep meets every pair once, in rounds of disjoint pairs that are rotated together.
    """
    columns, k = factor.T.copy(), factor.shape[1]
    seats = np.arange(k + k % 2)
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            p, q = seats[:half], seats[half:][::-1]
            both = (p < k) & (q < k)
            worst = max(worst, _rotate(columns, p[both], q[both]))
            seats[1:] = np.roll(seats[1:], 1)
        if worst < 1e-15:
            break
    return columns.T


def _rotate(columns: np.ndarray, p: np.ndarray, q: np.ndarray) -> float:
    """Make the pairs of rows p and q orthogonal; the largest cosine that was found."""
    if not len(p):
        return 0.0
    a, b = columns[p], columns[q]
    aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
    scale = np.sqrt(aa * bb)
    cosine = np.divide(np.abs(ab), scale, out=np.zeros_like(ab), where=scale > 0)
    turn = cosine > 1e-16
    zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
    t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
    c = np.where(turn, 1 / np.sqrt(1 + t * t), 1.0)
    s = np.where(turn, c * t, 0.0)
    columns[p] = c[:, None] * a - s[:, None] * b
    columns[q] = s[:, None] * a + c[:, None] * b
    return float(cosine.max())


@dataclass
class Whitening:
    """n, exact sums, and the components with a positive eigenvalue: rows of ``vectors``, in falling
    order of ``values``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _times_minus(self.n, x, self.sums)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        y = centred.astype(np.float64) / self.n
        return np.stack([(y * v).sum(axis=1) for v in self.vectors], axis=1) / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (x): its components of positive variance, ``components`` at most;
    None for an empty table. Only sums and one matrix of the vectors' size reach the driver."""
    partials = stored(rows.select("x").mapInArrow(
        _partials, "n bigint, high array<bigint>, low array<bigint>, scatter array<double>"
    ), "scatters")
    n = partials.agg(F.sum("n")).first()[0]
    if not n:
        return None
    halves = zip(_summed(partials, "high", "decimal(38,0)"), _summed(partials, "low", "decimal(38,0)"))
    sums = [(int(h) << 32) + int(b) for h, b in halves]
    own = F.transform(
        F.arrays_zip("high", "low"),
        lambda s: (s["high"].cast("double") * float(1 << 32) + s["low"].cast("double")) / F.col("n"),
    )
    mean = np.array([s / n for s in sums])
    scatter = _merged_scatter(partials.select("n", own.alias("mean"), "scatter"), mean) / n
    factor, order = pivoted_cholesky(scatter)
    rotated = jacobi_columns(factor)
    values = (rotated**2).sum(axis=0)
    first = np.argsort(-values, kind="stable")[:components]
    first = first[values[first] > 0]
    vectors = np.zeros((len(first), len(sums)))
    vectors[:, order] = (rotated[:, first] / np.sqrt(values[first])).T
    return Whitening(n, sums, values[first], vectors, float(np.trace(scatter)))


def _projected(shared, final: bool):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                centred = model.centred(_matrix(part.column(1)))
                white = model.whiten(centred)
                if final:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), _deviations(centred), pa.array(list(white), pa.list_(pa.float64()))],
                        ["vec_id", "deviation", "whitened"],
                    )
                else:
                    mean = white.mean(axis=0)
                    y = white - mean
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([len(white)], pa.int64()),
                            pa.array([mean], pa.list_(pa.float64())),
                            pa.array([(y.T @ y).ravel()], pa.list_(pa.float64())),
                        ],
                        ["n", "mean", "scatter"],
                    )

    return project


def _deviations(centred: np.ndarray) -> pa.Array:
    """Sums of squares, exactly; null beyond 64 bits."""
    most = max(int(centred.max(initial=0)), -int(centred.min(initial=0)))
    if most * most * max(centred.shape[1], 1) < 2**63:
        return pa.array((centred.astype(np.int64) ** 2).sum(axis=1), pa.int64())
    totals = (centred.astype(object) ** 2).sum(axis=1)
    return pa.array([int(t) if t < 2**63 else None for t in totals], pa.int64())


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity: one more pass,
    in batches centred on their own means, which are merged round the common one."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    partials = stored(rows.select("vec_id", "x").mapInArrow(
        _projected(shared, final=False), "n bigint, mean array<double>, scatter array<double>"
    ), "whitened-scatters")
    weighted = F.transform("mean", lambda m: m * F.col("n"))
    mean = np.array(_summed(partials.select(weighted.alias("mean")), "mean", "double")) / model.n
    covariance = _merged_scatter(partials, mean) / model.n
    return float(np.abs(covariance - np.eye(len(mean))).max(initial=0.0))


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding", key: str = "vec_id"
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector that
    takes part (see ``grid_vectors``) and each component.

    Components are those of positive variance, ``components`` at most: vectors that are all equal,
    or a single one, have none and give no rows, and so does an empty table. Rows that repeat a
    key are vectors of their own. Other columns play no part. A deviation beyond 64 bits is null.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = grid_vectors(vectors, column, key)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    error = identity_error(rows, model)
    shared = spark.sparkContext.broadcast(model)
    found = rows.mapInArrow(
        _projected(shared, final=True), "vec_id bigint, deviation bigint, whitened array<double>"
    )
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return found.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
