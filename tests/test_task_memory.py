"""What one task sorts stays as large when the input grows; the vote by minima equals the scan of threads."""

import random

from pyspark.sql import functions as F

from plyframe.plans import aggregates, endgames


def _sorts(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Sort [")


def test_bands_are_sorted_once_in_partitions_that_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(endgames, "SORTED", 10)
    moves = spark.range(1000).selectExpr("id div 5 AS o_orderkey", "char(97 + id * 7 % 5) AS uci", "id * 11 % 3 AS rank")
    got = endgames.banded(moves, 200)
    assert got.rdd.getNumPartitions() == 20 and _sorts(got) == 1
    want = {}
    for r in moves.collect():
        want.setdefault(r["o_orderkey"], []).append((-r["rank"], r["uci"]))
    want = sorted((k, u, -s, len({t for t, _ in m if t < s}) + 1, i + 1) for k, m in want.items() for i, (s, u) in enumerate(sorted(m)))
    assert got.columns == ["o_orderkey", "uci", "rank", "band", "place"] and sorted(map(tuple, got.collect())) == want


def scan(threads, win=31507, none=-32001):
    """thread, move, score, depth, line of one request, in the words of the rule."""
    least = min(t[2] for t in threads)
    own = [(s - least + 14) * d for _, _, s, d, _ in threads]
    votes = {}
    for (_, m, *_), o in zip(threads, own):
        votes[m] = votes.get(m, 0) + o
    rows = sorted((t, m, s, o, votes[m], line) for (t, m, s, _, line), o in zip(threads, own))
    best = rows[0]
    for x in rows[1:]:
        lost = lambda r: r[2] <= -win and r[2] != none
        weight = lambda r: r[3] if r[5] > 2 else 0
        if best[2] >= win:
            better = x[2] > best[2]
        elif lost(best):
            better = lost(x) and x[2] < best[2]
        else:
            better = x[2] >= win or lost(x) or (x[2] > -win and (x[4], weight(x)) > (best[4], weight(best)))
        best = x if better else best
    return best[0], best[1], best[4]


def test_votes_of_many_requests_equal_the_scan(spark):
    rng, rows = random.Random(3), []
    for request in range(1500):
        scores = rng.choice([[0, 1, 2], [0, 1, -32001], [-32001], [0, 31507, 31600, -31507], [-31507, -31600, 5, -32001, -32500], [31507, 31600, -31600]])
        for _ in range(rng.randint(1, 7)):
            rows.append((request, rng.randint(0, 5), rng.choice(scores), rng.randint(1, 4), rng.randint(0, 3), rng.randint(1, 4)))  # thread numbers occur twice
    df = spark.createDataFrame(rows, "req int, thread int, score long, depth long, move long, line int")
    want = {}
    for req, t, s, d, m, line in rows:
        want.setdefault(req, []).append((t, m, s, d, line))
    got = aggregates.vote(df.repartition(8, "req"), "req")
    assert {r["req"]: tuple(r)[1:] for r in got.collect()} == {k: scan(v) for k, v in want.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and _sorts(got) == 1


def test_votes_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "VOTED", 500)
    n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").agg(F.count(F.lit(1))).first()[0]
    assert aggregates.thread_vote(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == -(-n // 500) > 4
