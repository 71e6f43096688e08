"""The as-of join against brute force; numbers of pair features."""

import random

import pytest


@pytest.mark.parametrize("stretches", [1, 7])
def test_as_of_against_brute_force(spark, stretches):
    from plyframe.operators.asof import as_of

    rng = random.Random(stretches)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, None])  # noqa: E731  one key has most rows
    updates = [(key(), rng.randint(0, 60), rng.choice([None, i])) for i in range(120)]
    updates = list({(k, t): (k, t, v) for k, t, v in updates}.values())
    readings = [(i, key(), rng.randint(-2, 70), "x") for i in range(300)]
    u = spark.createDataFrame(updates, "user long, t int, v int")
    r = spark.createDataFrame(readings, "id int, user long, t int, _key string")
    got = {x["id"]: (x["v"], x["_key"]) for x in as_of(r, u, "user", ["t"], "v", stretches).collect()}
    assert len(got) == len(readings)
    for i, k, t, _ in readings:
        before = [(a, v) for b, a, v in updates if k is not None and b == k and a < t]
        assert got[i] == (max(before, key=lambda x: x[0])[1] if before else None, "x")


def test_as_of_of_nothing(spark):
    from plyframe.operators.asof import as_of

    none = spark.createDataFrame([], "k long, t int, v int")
    some = spark.createDataFrame([(1, 5)], "k long, t int")
    assert [tuple(r) for r in as_of(some, none, "k", ["t"], "v").collect()] == [(1, 5, None)]
    assert as_of(some.limit(0), none, "k", ["t"], "v").count() == 0


def test_number_of_pair_features():
    """Known: 79,856 features."""
    from plyframe.plans.threats import MEN, PLACES, numbering

    steps, pairs = numbering()
    own = {m: sum(s[0] == m for s in steps) for m in MEN}
    assert sum(PLACES[m.upper()] * own[m] for m in MEN) == 79_856 == 2 * sum(PLACES[m] * own[m] for m in "NBRQK") + PLACES["P"] * (own["P"] + own["p"])
    assert max(b + own[m] for m, _, b in pairs) <= 79_856 and len({(m, o) for m, o, _ in pairs}) == len(pairs)
