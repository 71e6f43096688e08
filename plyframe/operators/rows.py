"""Operators that Spark lacks, in Arrow batches: a kernel a row, and ordered folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def rows_of(df: DataFrame, kinds: str, work) -> DataFrame:
    """work(row as dict) gives result rows as tuples in the order of kinds."""
    schema = df.sparkSession.createDataFrame([], kinds).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                out = [r for row in part.to_pylist() for r in work(row)]
                columns = list(zip(*out)) if out else [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], names=arrow.names)

    return df.mapInArrow(run, kinds)


def spread(df: DataFrame, waves: int = 1) -> DataFrame:
    """Few rows with much work each: dealt to all cores, in so many waves."""
    return df.repartition(waves * df.sparkSession.sparkContext.defaultParallelism)


def widened(df: DataFrame) -> DataFrame:
    """Rows with much work each: dealt to all cores if the input has fewer partitions than that; larger inputs are left as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, rows: int, most: int, *by: str) -> DataFrame:
    """df by its columns `by` in so many partitions that one stands for about `most` of the counted rows, at least as many as the session
    shuffles into. Sorts of a task stay as large, whatever the input."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // most)), *by)


def folded(rows: DataFrame, kinds: str, start: tuple, step: Callable[[tuple, tuple], tuple]) -> DataFrame:
    """One row a key: the state after step(state, row) over the key's rows in order. rows: key, two columns that give the order, more.

    A fold isn't associative, so a key's rows pass through one task, but as a stream: a task holds one state and one batch.
    """
    key, *order = rows.columns[:3]
    names = [c.split()[0] for c in kinds.split(", ")]
    met = rows.repartition(key).sortWithinPartitions(key, *order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun = None, start, False
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or row[0] != now:
                    if begun:
                        out.append((now, *state))
                    now, state, begun = row[0], start, True
                state = step(state, row[3:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()) for c in (now, *state)], names)

    return met.mapInArrow(work, kinds)
