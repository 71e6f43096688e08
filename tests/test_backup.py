"""Stored trees against plain minimax by the kernel; requests that are stopped and resumed."""

import time

import pytest

from plyframe.functions import board as B
from plyframe.functions import kernel as K
from plyframe.operators import backup
from plyframe.operators.deepening import Deepening


def states(spark, fens):
    rows = spark.createDataFrame([(i, f, False) for i, f in enumerate(fens)], "pos_id int, fen string, chess960 boolean")
    return B.parse(rows).select("pos_id", backup.node_key().alias("node"), *backup.STATE)


def minimax(b, depth, ply=0):
    if depth == 0:
        return b.material(), []
    moves = [(b.text(m, False), b.after(m)) for m in b.moves()]
    if not moves:
        return (ply - backup.MATE if b.in_check() else 0), []
    found = [(*minimax(x, depth - 1, ply + 1), text) for text, x in moves]
    v, line, text = min(found, key=lambda r: (r[0], r[2]))
    return -v, [text, *line]


FENS = [
    "8/8/8/8/8/6k1/6p1/6K1 w - -", "7k/7P/6K1/8/3B4/8/8/8 b - -", "8/1p3pp1/7p/5P1P/2k3P1/8/2K2P2/8 w - - 0 1", "6k1/5ppp/8/8/8/8/5PPP/3R2K1 w - - 0 1", "2K5/p7/7P/5pR1/8/5k2/r7/8 w - - 0 1",
    "8/R7/2q5/8/6k1/8/1P5p/K6R w - - 0 124", "r3k3/8/8/8/3pP3/8/8/4K2R b Kq e3 0 1", "8/P7/8/8/8/8/k6p/2K5 w - - 0 1",
]


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_values_against_minimax(spark, depth):
    rows = states(spark, FENS + FENS[:2])  # equal roots are one node
    levels, edges = backup.grown(rows.select(*backup.STATE), depth)
    assert levels[0].count() == len(FENS)
    found = rows.join(backup.backed_up(levels, edges), "node").collect()
    assert len(found) == len(FENS) + 2
    for r in found:
        v, line = minimax(K.Board.parse((FENS + FENS[:2])[r["pos_id"]]), depth)
        assert (r["value"], r["line"]) == (v, " ".join(line)), FENS[r["pos_id"] % len(FENS)]


def test_positions_that_meet_are_one_node(spark):
    rows = states(spark, ["8/8/8/3k4/8/8/8/R3K3 w - - 0 1"])
    levels, edges = backup.grown(rows.select(*backup.STATE), 3)
    assert edges[2].count() > edges[2].select("child").distinct().count() == levels[3].count()


def slow(roots, depth):
    """A tree whose third depth doesn't end by itself."""
    if depth == 3:
        roots.sparkSession.range(0, 10**13, 1, 4).selectExpr("sum(hash(id) % 7)").collect()
    return backup.grown(roots, depth)


def test_one_of_two_requests_is_stopped_and_resumed(spark):
    rows = states(spark, FENS[:2] + FENS[3:4]).select(*backup.STATE)
    endless, other = Deepening(rows, 3, slow).start(), Deepening(rows, 2).start()
    deadline = time.time() + 120
    while endless.depth < 2 and time.time() < deadline:
        time.sleep(0.2)
    time.sleep(1)
    endless.stop()
    other.wait()
    assert (endless.depth, endless.error, other.depth, other.error) == (2, None, 2, None)  # the whole depths stay, the other went on
    same = lambda a, b: a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert same(endless.values, other.values)
    endless.tree = backup.grown
    assert endless.start().wait().depth == 3
    levels, edges = backup.grown(rows, 3)
    assert same(endless.values, backup.backed_up(levels, edges))


def test_a_failing_request_tells(spark):
    def broken(roots, depth):
        raise RuntimeError("no tree")

    request = Deepening(states(spark, FENS[:1]).select(*backup.STATE), 2, broken).start().wait()
    assert str(request.error) == "no tree" and request.depth == 0 and request.values is None
