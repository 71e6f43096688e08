"""Endgame tables in packed blocks: a row of Parquet for 16,384 keys in a row, sorted, so readers skip what they don't ask for.

A table is an array in key order. A value's symbol tells that there is no position, a draw, or who wins in how many plies. Blocks are
coded by themselves (functions/paircode.py), so a probe decodes the blocks of its keys and nothing else. Parquet keeps the sparse index:
row groups are small and carry the least and largest block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paircode
from ..operators.retrograde import CURSED

BLOCK = 16_384
ROWS = "key long, wdl int, dtz int, plies int"
PACKED = "block long, positions int, body binary"
#: Symbols: no position, a draw, then a win and a loss for each number of plies.
NONE, DRAW, WON, LOST = 0, 1, 2, 3
#: Bytes of a row group, so that a group holds few blocks.
GROUP = 1 << 18


def packed(tables: DataFrame) -> DataFrame:
    """block, positions, body. tables: key, wdl, plies, each key once. A block's rows meet in one task, at most 16,384 of them."""
    symbol = F.when(F.col("plies").isNull(), DRAW).otherwise(2 * F.col("plies") + F.when(F.col("wdl") > 0, WON).otherwise(LOST))
    rows = tables.select(F.expr(f"key div {BLOCK}").alias("block"), F.expr(f"CAST(key % {BLOCK} AS int)").alias("at"), symbol.cast("int").alias("s"))
    rows = rows.repartition("block").sortWithinPartitions("block")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, values = None, np.zeros(BLOCK, dtype=np.int32)

        def done() -> pa.RecordBatch:
            there = np.flatnonzero(values)
            return pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int64()), "positions": pa.array([len(there)], pa.int32()), "body": pa.array([paircode.encode(values)], pa.binary())})

        for batch in batches:
            block, at, s = (batch.column(c).to_numpy() for c in ("block", "at", "s"))
            edges = np.flatnonzero(np.diff(block)) + 1
            for low, high in zip([0, *edges], [*edges, len(block)]):
                if low == high:
                    continue
                if now is not None and block[low] != now:
                    yield done()
                    values[:] = NONE
                now = int(block[low])
                values[at[low:high]] = s[low:high]
        if now is not None:
            yield done()

    return rows.mapInArrow(work, PACKED)


def write_packed(tables: DataFrame, path: str) -> None:
    """The blocks in the order of keys."""
    blocks = packed(tables).repartitionByRange("block").sortWithinPartitions("block")
    blocks.write.option("parquet.block.size", str(GROUP)).option("compression", "uncompressed").parquet(path)


def blocks_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACKED).parquet(path)


def _values(block: int, at: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    plies = np.where(s > DRAW, (s - WON) // 2, 0)
    sign = np.where(s <= DRAW, 0, np.where(s % 2 == 0, 1, -1))
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array(at + block * BLOCK, pa.int64()),
            "wdl": pa.array(sign * np.where(plies > CURSED, 1, 2), pa.int32()),
            "dtz": pa.array(sign * np.maximum(plies, 1), pa.int32()),
            "plies": pa.array(plies, pa.int32(), mask=s == DRAW),
        }
    )


def read_packed(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """key, wdl, dtz, plies of the keys from low to high, both included; other blocks are neither read nor decoded."""
    rows = blocks_of(spark, path)
    if low is not None:
        rows = rows.where(F.col("block") >= low // BLOCK)
    if high is not None:
        rows = rows.where(F.col("block") <= high // BLOCK)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist()):
                s = paircode.decode(body)
                at = np.flatnonzero(s)
                if low is not None:
                    at = at[at + block * BLOCK >= low]
                if high is not None:
                    at = at[at + block * BLOCK <= high]
                yield _values(block, at, s[at])

    return rows.select("block", "body").mapInArrow(work, ROWS)


def probe_packed(asked: DataFrame, path: str, key: str = "key") -> DataFrame:
    """key, wdl, dtz, plies of the distinct keys that are asked for and there: a block is decoded once, where any of its keys is asked for."""
    keys = asked.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct()
    wanted = keys.groupBy(F.expr(f"key div {BLOCK}").alias("block")).agg(F.collect_list(F.expr(f"CAST(key % {BLOCK} AS int)")).alias("at"))  # at most 16,384

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, at, body in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "body"))):
                s, where = paircode.decode(body), np.sort(np.array(at, dtype=np.int64))
                where = where[s[where] != NONE]
                yield _values(block, where, s[where])

    return blocks_of(asked.sparkSession, path).select("block", "body").join(wanted, "block").select("block", "at", "body").mapInArrow(work, ROWS)
