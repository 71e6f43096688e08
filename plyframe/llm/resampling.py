"""Importance resampling of documents towards a target distribution of hashed word n-grams.

Each task walks its texts in blocks of bounded bytes. A block's words form a trie: a node is a run of one to three words and holds its
count and the CRC state of its bytes, which is its parent's state carried over the next word. The counts of a task's nodes are added
to 10,000 buckets by their states, and one row a bucket and task is merged over tasks. In the second pass the gain of its bucket is
attached to every node, and a document's weight is the sum over the paths that its words take.

The draw is by weight with Gumbel noise from a hash of doc_id. Ranks come from one range partitioning by score with the number of
rows of each partition; no task holds all rows.

Defined cases: null and empty texts have no words, no features and the weight 0; a null doc_id is hashed as the word null and comes
last among ties; repeated rows are rows of their own, with equal scores; rows that share doc_id and score but not the text are
ordered by features and weight; an empty target, or an empty table, has counts of 0; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, materialize, only, small

BUCKETS, DEPTH = 10_000, 3
#: Bytes to themselves in lower case where words hold them (digits, letters, all from 0x80 on), else 0.
WORD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], dtype=np.uint8)
LONGEST = 63


def _shifts() -> np.ndarray:
    """[length][byte of the state][value]: what this byte of a CRC-32 becomes after so many zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    now = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [now]
    for _ in range(LONGEST):
        now = step[now & np.uint32(255)] ^ (now >> np.uint32(8))
        out.append(now)
    return np.stack(out)


SHIFTS = _shifts()


def carried(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states after `length` more zero bytes: the CRC of a+b is carried(crc(a), len(b)) ^ crc(b)."""
    state, length = state.copy(), length.copy()
    while True:
        now = np.minimum(length, LONGEST)
        state = SHIFTS[now, 0, state & 255] ^ SHIFTS[now, 1, state >> 8 & 255] ^ SHIFTS[now, 2, state >> 16 & 255] ^ SHIFTS[now, 3, state >> 24]
        length -= now
        if not length.any():
            return state


class Trie:
    """The runs of one to DEPTH words of a block of texts.

    doc: the text of each word. paths: by depth, (first word of each run, its node); counts and states: by depth and node.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        at = offsets - offsets[0]
        low = WORD[data]
        inside = low != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = at[:-1][at[:-1] < len(data)]
        begins[edges] = inside[edges]  # words end with their text
        starts = np.flatnonzero(begins)
        self.n_texts = len(texts)
        self.doc = np.searchsorted(at[:-1], starts, side="right") - 1
        held = np.append((np.cumsum(inside) - 1)[starts], inside.sum()).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(held), pa.py_buffer(low[inside])]).dictionary_encode()
        self.ids = words.indices.to_numpy().astype(np.int64)
        self.words = words.dictionary.to_pylist()
        length = np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1
        after = np.fromiter((zlib.crc32(b" " + w) for w in self.words), np.uint32, len(self.words))
        self.counts = [np.bincount(self.ids, minlength=len(self.words))]
        self.states = [np.fromiter(map(zlib.crc32, self.words), np.uint32, len(self.words))]
        self.paths = [(np.arange(len(starts)), self.ids)]
        for depth in range(1, DEPTH):
            first, node = self.paths[-1]
            more = first + depth < len(starts)
            more[more] = self.doc[first[more] + depth] == self.doc[first[more]]
            first, node = first[more], node[more]
            key = node * max(1, len(self.words)) + self.ids[first + depth]
            child, keys = pd.factorize(key)
            parent, word = np.divmod(keys, max(1, len(self.words)))
            self.paths.append((first, child))
            self.counts.append(np.bincount(child, minlength=len(keys)))
            self.states.append(carried(self.states[-1][parent], length[word]) ^ after[word])

    def n_words(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_texts)

    def totals(self) -> np.ndarray:
        """Features by bucket."""
        out = np.zeros(BUCKETS, dtype=np.int64)
        for n, state in zip(self.counts, self.states):
            np.add.at(out, state % BUCKETS, n)
        return out

    def walked(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, sum of gains) of each text."""
        n, weight = np.zeros(self.n_texts, dtype=np.int64), np.zeros(self.n_texts, dtype=np.int64)
        for (first, node), state in zip(self.paths, self.states):
            gain, doc = gains[state % BUCKETS][node], self.doc[first]
            n += np.bincount(doc, minlength=self.n_texts)
            # sums of whole numbers below 2^53 are exact in doubles
            weight += np.bincount(doc, weights=gain, minlength=self.n_texts).astype(np.int64)
        return n, weight


def bucket_totals(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: a row a bucket and task is shuffled, 10,000 come to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            total += Trie(batch.column("text")).totals()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    rows = in_batches(only(texts, text="string"), work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed share in the target over that in the source)) by bucket."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trie = Trie(batch.column("text"))
            n, weight = trie.walked(gains)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(trie.n_words()), pa.array(n), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return in_batches(only(docs, doc_id="long", text="string"), work, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, take: int) -> DataFrame:
    """rows with `rank` (1, 2, 3 in that order) up to `take`, null beyond: one range partitioning, numbered within partitions."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    kept = materialize(sorted_rows, "resampling-order")
    part = F.shiftright("_at", 33)
    sizes = sorted(kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["part"], before))
        before += r["n"]
    offsets = small(rows.sparkSession, offsets, {"_part": "long", "_before": "long"})
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    met = kept.join(F.broadcast(offsets), part == F.col("_part"))
    return met.withColumn("rank", F.when(rank <= take, rank)).drop("_at", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least: int = 20, seed: int = 42) -> DataFrame:
    """One row per row of docs: doc_id, n_features, weight, score, rank (null if not drawn) and n_words."""
    gains = bucket_gains(bucket_totals(docs), bucket_totals(target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialize(weigh(docs, gains).withColumn("score", F.col("weight") + noise), "resampling-scores")
    takes_part = F.col("n_words") >= least
    take = percent * scored.where(takes_part).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    drawn = ranked(scored.where(takes_part), order, take)
    out = drawn.unionByName(scored.where(~takes_part).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
