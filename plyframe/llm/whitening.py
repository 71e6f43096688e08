"""Whitening of embeddings by a covariance in two passes.

A component c becomes the whole number x = floor(64 * c) + 1000000. The covariance is fitted on each distinct vector once, so that
copies don't weigh. First pass: exact sums of x give the mean. Second pass: every task sums the outer products of its centred
vectors by matrix products, a tree of tasks merges the sums. The driver holds one square of the dimension, takes its symmetric
eigenvectors and broadcasts the projection.

Defined cases: vectors that are null, empty or hold nulls or entries that aren't finite take no part, neither do those with an entry
from 2^44 on (exact sums would not be whole) nor those of another length than most vectors have (of equally many, the longer);
null and repeated vec_id are values like others, so repeated rows give repeated results; a component with an eigenvalue of no more
than 1e-12 of the largest can't be scaled and is left out, so one distinct vector alone, or an empty table, gives no rows; a
deviation that no long holds is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, in_batches, materialize, only

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**44
LOW = 1 << 32
#: Eigenvalues down to this share of the largest count as more than rounding.
LEAST = 1e-12


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the vectors that take part, in one length."""
    rows = only(vectors, vec_id="long", embedding="array<double>")
    # a null among the entries makes forall null or false, which the filter drops
    rows = rows.where(f"size(embedding) > 0 AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < {LARGEST})")
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max_by("d", F.struct("n", "d")).alias("d")).first()["d"]
    x = F.transform("embedding", lambda c: F.floor(SCALE * c) + F.lit(SHIFT))
    return rows.where(F.size("embedding") == (most or 0)).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, as whole numbers of any size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n, high, low = n + len(x), high + (x // LOW).sum(axis=0), low + (x % LOW).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(len(high)), pa.int32()), "n": pa.array([n] * len(high)), "high": pa.array(high), "low": pa.array(low)})

    parts = in_batches(fit.select("x"), work, "dim int, n long, high long, low long")
    rows = sorted(parts.groupBy("dim").agg(F.sum("n"), F.sum("high"), F.sum(F.col("low").cast("decimal(38,0)"))).collect())  # a row a dimension
    return (rows[0][1], [r[2] * LOW + int(r[3]) for r in rows]) if rows else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(n*x - S, exact; (n*x - S) / n)."""
    if n * float(np.abs(x).max(initial=0)) < 2.0**61:
        d = n * x - np.array(sums, dtype=np.int64)
        return d, d / n
    d = n * x.astype(object) - np.array(sums, dtype=object)
    return d, (d / n).astype(np.float64)


def deviations(d: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where a long doesn't hold one."""
    if np.square(d.astype(np.float64)).sum(axis=1).max(initial=0.0) >= 2.0**62:
        d = d.astype(object)
    return [int(v) if v < 1 << 63 else None for v in np.square(d).sum(axis=1).tolist()]


def _gathered(fit: DataFrame, size: tuple[int, ...], part) -> np.ndarray:
    """The sum of part(x) over all batches: within tasks, then by a tree of tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(_matrix(batch))
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    parts = in_batches(fit.select("x"), work, "m binary").rdd
    return parts.treeAggregate(np.zeros(size), lambda a, r: a + np.frombuffer(r["m"]).reshape(size), np.add, depth=2)


def components(fit: DataFrame, n: int, sums: list[int], most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(projection, one column a component; eigenvalues; trace of the covariance). The largest entry of each eigenvector is positive."""

    def outer(x: np.ndarray) -> np.ndarray:
        c = centred(x, n, sums)[1]
        return c.T @ c

    covariance = _gathered(fit, (len(sums), len(sums)), outer) / n
    e, v = np.linalg.eigh(covariance)
    order = np.argsort(-e, kind="stable")[:most]
    order = order[e[order] > LEAST * max(e.max(initial=0.0), 0.0)]
    e, v = e[order], v[:, order]
    v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)
    return v / np.sqrt(e), e, float(np.trace(covariance))


def whiten(vectors: DataFrame, most: int = 16) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(fit)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if n == 0:
        return spark.createDataFrame([], kinds)
    w, e, trace = components(fit, n, sums, most)
    if not len(e):
        return spark.createDataFrame([], kinds)
    held = spark.sparkContext.broadcast((w, n, sums))

    def project(x: np.ndarray) -> np.ndarray:
        w, n, sums = held.value
        return centred(x, n, sums)[1] @ w

    mean = _gathered(fit, (len(e),), lambda x: project(x).sum(axis=0)) / n

    def squares(x: np.ndarray) -> np.ndarray:
        z = project(x) - mean
        return z.T @ z

    error = float(np.abs(_gathered(fit, (len(e), len(e)), squares) / n - np.eye(len(e))).max())
    discard(fit)
    explained = e / trace

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n, sums = held.value
        k = w.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            d, c = centred(_matrix(batch), n, sums)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(c)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(c))),
                    pa.array(np.full(len(c) * k, n, dtype=np.int64)),
                    pa.array([v for v in deviations(d) for _ in range(k)], pa.int64()),
                    pa.array((c @ w).ravel()),
                    pa.array(np.tile(explained, len(c))),
                    pa.array(np.full(len(c) * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return in_batches(rows, work, kinds)
