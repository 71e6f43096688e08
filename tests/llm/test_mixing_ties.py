"""Mixing where many rows have no doc_id, or are the same row."""

import pytest
from pyspark.sql import functions as F


def test_no_hot_bucket(spark):
    from plyframe.llm.mixing import measured, source_targets, streams

    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same words").otherwise(F.concat_ws(" ", "id", F.lit("w"))).alias("text"), F.lit("a").alias("source")
    )
    meas = measured(rows)
    assert meas.count() == n
    placed = streams(meas, source_targets(meas), per_task=1000)
    sizes = [r["count"] for r in placed.groupBy("src", "b").count().collect()]
    assert sum(sizes) == n and len(sizes) == 32 and max(sizes) < 1.3 * n / 32
    assert placed.select("src", "b", "r").distinct().count() == n and placed.select("at").where("at >= 0").distinct().count() == n


def test_identical_rows(spark, monkeypatch):
    from plyframe.llm import mixing

    monkeypatch.setattr(mixing, "RUN", 64)  # lots over several tasks
    rows = [(None, "one two three", "a")] * 500 + [(7, "x", "a")] * 3 + [(None, None, None), (8, "y z", "b"), (9, "q " * 100, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = (sorted(map(tuple, mixing.mix_counts(docs.repartition(k)).collect()), key=str) for k in (2, 5))
    assert first == again and len(first) == len(rows)
    for source_size in {r[2] for r in first}:
        got = [r for r in first if r[2] == source_size]
        assert sum(r[4] for r in got) == pytest.approx(got[0][3], abs=1)
    assert all(r[4] <= 3 * r[1] for r in first)
