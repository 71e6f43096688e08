"""Exact top-k by inner product with a three-phase uniform threshold.

The dimensions are dealt to M lists; a row's score for a query is the sum of its M local scores. Rows are dealt to blocks of bounded
size in the order of their length (norm), queries to blocks by number: a task holds one block of rows and asks one block of
queries after another.

1. Each block of rows gathers, for each list, the k best local scores, and resolves these rows' scores alone; the k-th best over
   all blocks bounds the query's k-th score from below: the safe cutoff t.
2. The cutoffs go to all blocks with the queries. A row whose local scores are all below t / M scores below t, so only
   entries of at least t / M in some list are collected. Where a list's longest row can't reach t / M with a query, the
   list isn't scored for it: short rows, which share blocks, drop out together.
3. What is collected is resolved exactly, rows below t go, and the k best of each query are ranked.

A full score is computed for collected rows alone.

Scores are whole numbers. Where a block pair's values are small enough for 53 bits they are multiplied as doubles, which is
exact; else as Python integers.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without an
id; components that a shorter vector lacks count as 0; ties go to the smaller id; of rows repeated with one id each takes
part, and a query with that id has none of them as a candidate; a query repeated with the same id and vector is one query,
with different vectors the one that sorts first; no queries or no candidates give no rows; extra columns are ignored.
A score beyond 64 bits raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, materialize, only

#: Rows of a block, queries of a block, lists.
ROWS, QUERIES, LISTS = 2048, 64, 2
SCALE = 1024


def whole(embedding: str = "embedding") -> Column:
    """floor(SCALE * x) of each component as double; null where the vector takes no part."""
    x = F.col(embedding).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) | (F.abs(v * SCALE) == float("inf")))
    return F.when((F.size(x) > 0) & ~bad, F.transform(x, lambda v: _floor(v * SCALE)))


def _floor(v: Column) -> Column:
    """Floor that stays a double, as large values have no fraction anyway."""
    return F.when(F.abs(v) < float(1 << 52), F.floor(v).cast("double")).otherwise(v)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _lists(width: int) -> list[slice]:
    step = -(-width // LISTS)
    return [slice(a, min(width, a + step)) for a in range(0, width, step)]


def _exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are if their products are exact as doubles, else as Python integers."""
    large = max(float(np.abs(q).max(initial=0)), 1.0) * max(float(np.abs(x).max(initial=0)), 1.0) * q.shape[1]
    if large < 1 << 53:
        return q, x
    return tuple(np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (q, x))


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Where the k best scores are, ties to the first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], i))[:k])
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    over = np.flatnonzero(scores > edge)
    return np.concatenate([over, np.flatnonzero(scores == edge)[: k - len(over)]])


def _norms(m: np.ndarray, lists: list[slice]) -> np.ndarray:
    """Of each row, the length in each list; a little more, so that rounding doesn't matter."""
    return np.stack([np.sqrt((m[:, s] * m[:, s]).sum(1)) for s in lists], 1) * (1 + 1e-9)


def _score(q: np.ndarray, q_ids: np.ndarray, cuts: list, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, row, score): phase 1 for queries without a cutoff, else phases 2 and 3. Rows stand in the order of their ids."""
    lists = _lists(q.shape[1])
    longest, own = _norms(x, lists).max(0, initial=0), _norms(q, lists)
    exact_q, exact_x = _exact(q, x)
    near: list[list[np.ndarray]] = [[] for _ in q_ids]
    for m, part in enumerate(lists):
        asked = [j for j, cut in enumerate(cuts) if cut is None or not own[j, m] * longest[m] * len(lists) < cut]
        if not asked:
            continue
        local = exact_q[asked, part] @ exact_x[:, part].T
        for row, j in zip(local, asked):
            if cuts[j] is None:
                others = np.flatnonzero(ids != q_ids[j])
                near[j].append(others[_top(row[others], k)])
            else:
                near[j].append(np.flatnonzero((row * len(lists) >= cuts[j]).astype(bool)))
    found = []
    for j, query in enumerate(q_ids.tolist()):
        at = np.unique(np.concatenate([np.empty(0, np.int64), *near[j]]))
        at = at[ids[at] != query]
        mine = exact_x[at] @ exact_q[j]
        if cuts[j] is not None:
            keep = (mine >= cuts[j]).astype(bool)
            at, mine = at[keep], mine[keep]
        best = _top(mine, k)
        found += [(query, int(ids[i]), int(v)) for i, v in zip(at[best], mine[best])]
    return found


def _work(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block come before its queries (b, is_q, id, v, cut)."""
    block, held, x, ids = None, [], None, None
    for batch in batches:
        for a in range(0, batch.num_rows, QUERIES):
            part = batch.slice(a, QUERIES)
            bs = part.column("b").to_numpy(zero_copy_only=False)
            is_q = part.column("is_q").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((bs[1:] != bs[:-1]) | (is_q[1:] != is_q[:-1])) + 1), len(bs)]
            for lo, hi in zip(edges, edges[1:]):
                run = part.slice(lo, hi - lo)
                m, own = _matrix(run.column("v"), width), run.column("id").to_numpy()
                if bs[lo] != block:
                    block, held, x = bs[lo], [], None
                if not is_q[lo]:
                    held.append((own, m))
                    continue
                if x is None:
                    if not held:
                        continue
                    ids, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                    held = [(ids, x)]
                    order = np.argsort(ids, kind="stable")
                    ids, x = ids[order], x[order]
                if found := _score(m, own, run.column("cut").to_pylist(), x, ids, k):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["query_id", "vec_id", "score"])


def top_k(table: DataFrame, is_query: Column, k: int = 10, row_block: int = ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on vec_id."""
    rows = only(table, vec_id="long", embedding="").select("vec_id", whole().alias("v")).where("v is not null and vec_id is not null")
    rows = materialize(rows, "topk-rows")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    length = F.aggregate("v", F.lit(0.0), lambda s, v: s + v * v)
    blocks = max(1, -(-n // row_block))
    # equal lengths are dealt by hash, so that a block is bounded whatever the rows are
    dealt = rows.withColumn("_n", length).repartitionByRange(blocks, F.desc("_n"), F.xxhash64("vec_id", "v")).select(F.spark_partition_id().cast("long").alias("b"), F.lit(False).alias("is_q"), F.col("vec_id").alias("id"), "v", F.lit(None).cast("long").alias("cut"))
    dealt = materialize(dealt, "topk-blocks")
    last_block = dealt.agg(F.coalesce(F.max("b"), F.lit(0))).first()[0]
    queries = materialize(rows.where(is_query).groupBy(F.col("vec_id").alias("id")).agg(F.min("v").alias("v")), "topk-queries")

    def scored(with_cut: DataFrame) -> DataFrame:
        """Each query meets each block of rows, not each row."""
        asked = with_cut.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last_block).cast("long"))).alias("b"), F.lit(True).alias("is_q"), "id", "v", "cut")
        met = dealt.unionByName(asked).repartition("b").sortWithinPartitions("b", "is_q", "id")
        return in_batches(met, lambda batches: _work(batches, k, width or 0), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    first = scored(queries.withColumn("cut", F.lit(None).cast("long")))
    cut = ranked(first).groupBy("query_id").agg(F.min("score").alias("cut"), F.count(F.lit(1)).alias("n"))
    # a query with fewer than k candidates has no cutoff: phase 1 resolves them all
    cut = materialize(cut.select(F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("cut")).alias("cut")), "topk-cut")
    last = scored(queries.join(cut, "id"))
    return ranked(last).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
