"""Positions that many orders ask for are worked on once; every order gets its rows."""

import os

import pytest
from pyspark.sql import functions as F

from plyframe import registry
from plyframe.functions import board as B
from plyframe.plans import text as T
from plyframe.sources import corpus as C

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Queries whose work a position is heavy.
ONCE = [
    "k6_named_moves",
    "g10_made_moves",
    "f8_checks",
    "g5_legal_moves",
    "a14_sparse_sums",
    "k11_piece_worth",
    "f1_attacked_squares",
]


@pytest.mark.parametrize("name", ONCE)
def test_each_position_is_worked_on_once(spark, monkeypatch, name):
    seen, parse = [], B.parse
    monkeypatch.setattr(B, "parse", lambda df, *a: seen.append(df) or parse(df, *a))
    registry.queries()[name](spark, SF)
    assert len(seen) == 1
    assert seen[0].count() <= C.SIZE < spark.read.parquet(f"{SF}/orders.parquet").count()


def test_every_order_is_answered(spark, tmp_path):
    """Keys given twice, negative, null; positions that nobody asks for aren't worked on."""
    keys = [(7,), (7,), (57,), (-43,), (None,), (100,), (12,)]
    spark.createDataFrame(keys, "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    met = []

    def work(positions):
        met.append(sorted(r["pos_id"] for r in positions.collect()))
        return positions.where("pos_id <> 12").select(F.explode(F.array(F.lit(1), F.lit(2))).alias("n"), "pos_id", "fen")

    got = C.answered(spark, str(tmp_path), work)
    assert got.columns == ["pos_id", "n", "fen"]
    assert met == [[0, 7, 12]]
    expected = [(k, n, f) for k, f, *_ in C.asked(spark, str(tmp_path)).collect() if k != 12 for n in (1, 2)]
    assert sorted(map(tuple, got.collect())) == sorted(expected) and len(expected) == 10


def test_named_moves_in_one_pass(spark):
    """A move asked for twice counts once; of a position without hits all moves count; a position without moves has no row."""
    legal = spark.createDataFrame([(1, "a2a3"), (1, "b2b3"), (1, "c2c3"), (2, "e2e4"), (2, "d2d4")], "pos_id long, uci string")
    asked = spark.createDataFrame([(1, "b2b3"), (1, "b2b3"), (1, "c2c3"), (2, "a2a3"), (3, "a2a3")], "pos_id long, uci string")
    assert sorted(map(tuple, T.named(legal, asked).collect())) == [(1, 2, "b2b3"), (2, 2, "d2d4")]
