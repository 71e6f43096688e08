"""Whitening against numpy on the whole table."""

import math
import random

import numpy as np
import pytest

KINDS = "vec_id long, embedding array<float>, n string, x int, component string"


def vectors(n=300, d=20, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]


def run(spark, rows, **more):
    from plyframe.llm.whitening import whiten

    return whiten(spark.createDataFrame([(i, v, "a", 1, "b") for i, v in rows], KINDS).repartition(3), **more)


def check(got, rows, most=16):
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(most, len(s))
    assert len(got) == len(kept) * k and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    sign = {}
    for i, x in kept:
        d = [n * a - b for a, b in zip(x, s)]
        for j in range(k):
            r = by[i, j + 1][0]
            assert r["deviation"] == sum(a * a for a in d)
            assert r["explained"] == pytest.approx(e[j] / e.sum(), rel=1e-9)
            want = float(np.array(d) / n @ v[:, j]) / math.sqrt(e[j])
            if j not in sign and abs(want) > 0.1:
                sign[j] = math.copysign(1, want * r["whitened"])
            assert r["whitened"] == pytest.approx(sign.get(j, 1) * want, abs=1e-6 if j in sign else 0.3)


def test_whitening_against_numpy(spark):
    rows = vectors()
    rng = random.Random(1)
    rows += [(1000 + k, rows[rng.randrange(5)][1]) for k in range(400)]  # copies don't weigh
    rows += [rows[0], (None, rows[9][1])]
    odd = [(2000, None), (2001, []), (2002, [None] + rows[1][1][1:]), (2003, [math.nan] + rows[1][1][1:]), (2004, [math.inf] + rows[1][1][1:])]
    check(run(spark, rows + odd).collect(), rows)


def test_fewer_components_and_another_length(spark):
    rows = vectors(60, 5)
    got = run(spark, rows + [(900, [1.0, 2.0])]).collect()
    check(got, rows)
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5}


def test_flat_dimensions_are_left_out(spark):
    rows = [(i, [float(i), 1.0, float(2 * i)]) for i in range(40)]  # one direction alone varies
    got = run(spark, rows).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1) and got[0]["identity_error"] < 1e-9


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2.0**43 - i * 2.0**20), float(i * i)]) for i in range(30)] + [(99, [2.0**45, 0.0])]
    got = run(spark, rows).collect()
    xs = [[math.floor(64 * np.float32(c).item()) + 1_000_000 for c in v] for _, v in rows[:30]]
    n, s = 30, [sum(c) for c in zip(*xs)]
    want = [sum((n * a - b) ** 2 for a, b in zip(x, s)) for x in xs]
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: w if w < 1 << 63 else None for i, w in enumerate(want)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    found = run(spark, rows)
    assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
