"""Dense keys of positions, and tables of the fixpoint against a solver in numpy, known counts and their own moves."""

import random

import pytest
from pyspark.sql import functions as F

from plyframe.functions import endgames as E
from plyframe.functions import kernel as K
from plyframe.functions.placement import BITS, Men
from plyframe.operators import retrograde as R


@pytest.mark.parametrize("white, black", [("Q", ""), ("P", ""), ("NN", ""), ("R", "B"), ("QR", ""), ("BBB", "")])
def test_keys_are_a_bijection(spark, white, black):
    """Every number gives a position whose number is itself, or the smaller one of its mirror; no two positions share one."""
    men = Men(white, black)
    whole = men.size() < 200_000
    ids = spark.range(men.size()).withColumnRenamed("id", "i")
    ids = ids if whole else ids.where("i % 997 IN (3, 500)")
    back = men.ranked(men.placed(ids, "i"))
    n, own, larger, missing = back.selectExpr("count(*)", "sum(int(key = i))", "sum(int(key > i))", "sum(int(key IS NULL))").first()
    assert larger == 0 and own > 0.88 * n and (missing == 0 or men.pawn)
    men_there = men.placed(ids, "i").select(F.size(F.array_distinct(F.array(*men.squares))).alias("n")).agg(F.min("n")).first()[0]
    assert men_there == len(men.squares)


@pytest.mark.parametrize("white, black", [("Q", ""), ("NN", ""), ("R", "B"), ("P", "")])
def test_mirrors_share_a_key(spark, white, black):
    men = Men(white, black)
    rows = men.placed(spark.range(men.size()).withColumnRenamed("id", "i").where("i % 1009 = 7"), "i")
    turns = ["x ^ 7"] if men.pawn else ["x ^ 7", "x ^ 56", "x % 8 * 8 + x div 8"]
    for turn in turns:
        turned = rows.selectExpr("i", "stm", *[f"CAST({turn.replace('x', c)} AS int) AS {c}" for c in men.squares])
        both = men.ranked(rows, to="a").select("i", "a").join(men.ranked(turned, to="b").select("i", "b"), "i")
        assert both.where("NOT (a <=> b)").count() == 0
    swapped = rows.selectExpr("i", "stm", "wk", "bk", "m1 AS m0", "m0 AS m1") if white == "NN" else rows
    assert men.ranked(swapped, to="a").join(men.ranked(rows, to="b").select("i", "b"), "i").where("NOT (a <=> b)").count() == 0


def test_positions_that_cannot_be_have_no_key(spark):
    rows = spark.createDataFrame([(0, 0, 1, 20), (0, 0, 20, 20), (0, 5, 20, 5), (0, 0, 20, 30)], "stm int, wk int, bk int, m0 int")
    assert [r["key"] is None for r in Men("Q").ranked(rows).collect()] == [True, True, True, False]
    pawns = spark.createDataFrame([(0, 0, 20, 3), (0, 0, 20, 60), (0, 0, 20, 12)], "stm int, wk int, bk int, m0 int")
    assert [r["key"] is None for r in Men("P").ranked(pawns).collect()] == [True, True, False]
    with pytest.raises(ValueError):
        Men("QP")


@pytest.mark.parametrize("kind", "QRBNKP")
def test_attacks_against_the_kernel(spark, kind):
    from plyframe.functions.placement import attacks

    rng = random.Random(ord(kind))
    rows, want = [], []
    for _ in range(3000):
        s, t, *others = rng.sample(range(64), 6)
        cells = [0] * 64
        cells[s] = getattr(K, {"B": "BI"}.get(kind, kind))
        for o in others:
            cells[o] = K.P + 8
        occ = sum(1 << x for x in (s, t, *others))
        rows.append((s, t, occ - (1 << 64) if occ >> 63 else occ))
        if kind == "K":
            want.append(t in K.KING[s])
        elif kind == "N":
            want.append(t in K.KNIGHT[s])
        elif kind == "P":
            want.append(t in K.PAWN[0][s])
        else:
            ways = {"B": K.SLANTED, "R": K.STRAIGHT, "Q": K.STRAIGHT + K.SLANTED}[kind]
            want.append(any(t in r[: next((i for i, x in enumerate(r) if x in others), 8)] for r in (K.RAYS[s][d] for d in ways)))
    got = spark.createDataFrame(rows, "s int, t int, occ long").selectExpr(f"{attacks(kind, 0, 's', 't', 'occ')} AS hit").collect()
    assert [r["hit"] for r in got] == want and any(want)


def squares(spark, solved, letter):
    men = Men(letter)
    low = R.CODE[men.name] << BITS
    return men.placed(solved.where(F.col("key").between(low, low + men.size() - 1)))


@pytest.mark.parametrize("letter", "QRBN")
def test_tables_against_the_solver(spark, letter):
    wdl, dtm = E.solve(letter)
    rows = squares(spark, R.tables(spark), letter).collect()
    assert all((wdl[r["stm"], r["wk"], r["m0"], r["bk"]], max(0, dtm[r["stm"], r["wk"], r["m0"], r["bk"]])) == (r["wdl"], r["plies"] or 0) for r in rows)
    boards = sum(4 if all(s // 8 == s % 8 for s in (r["wk"], r["bk"], r["m0"])) else 8 for r in rows)
    assert boards == (wdl != E.ILLEGAL).sum()


def test_known_counts(spark):
    """Known of king and pawn against king: of 81,664 positions with the pawn's side to move 62,480 are won; of 84,012 others 48,802 are lost."""
    found = squares(spark, R.tables(spark), "P").groupBy("stm", "wdl").count().collect()
    assert {(r["stm"], r["wdl"]): r["count"] for r in found} == {(0, 2): 62480, (0, 0): 19184, (1, -2): 48802, (1, 0): 35210}


def test_every_value_follows_from_the_moves(spark):
    """One ply of minimax over the tables gives the tables again."""
    solved = R.tables(spark).cache()
    for letter in "RP":
        men = Men(letter)
        rows = R.with_check(squares(spark, solved, letter), men)
        after = R.moves(R.stored(rows, "test-rows"), men, "key").join(F.broadcast(solved.selectExpr("key AS dst", "wdl AS w", "plies AS p")), "dst", "left")
        worth = "-coalesce(w, 0)"
        far = "CASE WHEN coalesce(w, 0) = 0 THEN NULL WHEN zeroing THEN 1 ELSE p + 1 END"
        best = after.groupBy("key").agg(F.expr(f"max({worth})").alias("best"), F.expr(f"min(CASE WHEN {worth} > 0 THEN {far} END)").alias("fast"), F.expr(f"max({far})").alias("slow"))
        met = rows.join(best, "key", "left").selectExpr("wdl", "plies", "coalesce(best, CASE WHEN checked THEN -2 ELSE 0 END) AS best", "CASE WHEN best > 0 THEN fast WHEN best < 0 THEN slow WHEN best IS NULL AND checked THEN 0 END AS far")
        assert met.where("wdl <> best OR NOT (plies <=> far)").count() == 0
    solved.unpersist()


def test_stages_lead_to_earlier_ones():
    assert R.needed(("KQvK",)) == [[("KQvK", None)]]
    assert R.needed(("KPvK",)) == [[(f"K{k}vK", None) for k in "QRBN"], *[[("KPvK", r)] for r in range(6, 0, -1)]]
    assert R.needed(("KRvKB",)) == [[("KRvK", None), ("KBvK", None)], [("KRvKB", None)]]


def test_reopened_tables(spark, tmp_path):
    solved = R.solve(spark, ("KBvK",), f"file://{tmp_path}/tables")
    again = R.opened(spark, f"file://{tmp_path}/tables")
    assert again.columns == ["key", "wdl", "dtz", "plies"] and again.exceptAll(solved).count() == solved.exceptAll(again).count() == 0 < again.count()


def test_four_men(spark):
    """Two knights don't force mate: white wins with a mating move alone, and what is mated or mates agrees with the kernel."""
    solved = R.tables(spark, ("KNNvK",))
    men = Men("NN")
    low = R.CODE[men.name] << BITS
    rows = solved.where(F.col("key").between(low, low + men.size() - 1))
    found = {(r["stm"], r["wdl"]): (r["n"], r["far"]) for r in rows.groupBy((F.col("key") % 2).alias("stm"), "wdl").agg(F.count(F.lit(1)).alias("n"), F.max("plies").alias("far")).collect()}
    assert set(found) == {(0, 0), (0, 2), (1, 0), (1, -2)} and found[0, 2][1] == 1 and found[1, -2][1] == 0
    won = men.placed(rows.where("wdl <> 0")).collect()
    for r in won:
        cells = ["."] * 64
        for c, s in (("K", "wk"), ("k", "bk"), ("N", "m0"), ("N", "m1")):
            cells[r[s]] = c
        board = "/".join("".join(cells[8 * k : 8 * k + 8]).replace(".", "1") for k in range(7, -1, -1))
        b = K.Board.parse(f"{board} {'wb'[r['stm']]} - - 0 1")
        after = [b.after(m) for m in b.moves()] if hasattr(b, "after") else None
        if r["stm"]:
            assert b.in_check() and not list(b.moves())
        elif after is not None:
            assert any(x.in_check() and not list(x.moves()) for x in after)
