"""Packed blocks: codes, whole tables, key ranges, probes."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plyframe.functions import paircode as P
from plyframe.operators import retrograde as R
from plyframe.sources import packed as S


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.lists(st.integers(-5, 5), max_size=600), st.lists(st.sampled_from([0, 1]), max_size=900), st.lists(st.integers(-(2**31), 2**31 - 1), max_size=60)))
def test_codes_round_trip(values):
    assert P.decode(P.encode(np.array(values, dtype=np.int32))).tolist() == values


@pytest.mark.parametrize("n", [1, 2, 3, 5, 1000, 4097])
def test_runs_of_one_value(n):
    data = P.encode(np.full(n, 7))
    assert P.decode(data).tolist() == [7] * n and len(data) < 200


def test_codes_are_prefix_free_and_short():
    size = P.lengths(np.array([50, 0, 20, 20, 5, 5]))
    words = [format(c, f"0{size[s]}b") for s, c in P.codes(size)]
    assert size[1] == 0 and not any(a != b and b.startswith(a) for a in words for b in words)
    assert sum(2.0 ** -int(x) for x in size if x) == 1 and size[0] == size.max() - 3 == 1
    rng = np.random.default_rng(1)
    values = np.repeat(rng.integers(0, 4, 300), rng.integers(1, 90, 300))
    assert len(P.encode(values)) < len(values) / 8


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('packed')}/tables"
    S.write_packed(R.tables(spark), path)
    return path


def test_tables_round_trip(spark, written):
    tables, back = R.tables(spark), S.read_packed(spark, written)
    assert back.columns == tables.columns and back.count() == tables.count()
    assert back.exceptAll(tables).count() == tables.exceptAll(back).count() == 0
    raw = sum(r["n"] for r in S.blocks_of(spark, written).select(F.length("body").alias("n")).collect())
    assert raw < tables.count()  # less than a byte a position


def test_key_ranges_reach_the_scan(spark, written):
    low, high = (4 << R.BITS) + 20_000, (4 << R.BITS) + 60_000
    part = S.read_packed(spark, written, low, high)
    want = R.tables(spark).where(F.col("key").between(low, high))
    assert part.exceptAll(want).count() == want.exceptAll(part).count() == 0 < want.count()
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(block,{low // S.BLOCK})" in plan and f"LessThanOrEqual(block,{high // S.BLOCK})" in plan


def test_probes_decode_the_blocks_asked_for(spark, written):
    tables = R.tables(spark)
    asked = tables.select("key").where("key % 9973 = 5").union(tables.select("key").limit(3)).union(spark.createDataFrame([(None,), (123,), (1 << 50,)], "key long"))
    asked = asked.union(asked)
    got = S.probe_packed(asked, written)
    want = tables.join(asked.distinct(), "key").select(*tables.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < want.count()
    assert S.probe_packed(asked.limit(0), written).count() == 0
