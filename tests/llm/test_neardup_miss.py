"""The chance that the sketch filters miss a link between large sets."""

import math

import pytest


@pytest.mark.parametrize("similarity", [0.80, 0.85])
def test_filters_miss_less_than_one_in_ten_millions(similarity):
    from plyframe.llm.neardup import K, MARGIN, SHARED

    below = lambda n: sum(math.comb(K, i) * similarity**i * (1 - similarity) ** (K - i) for i in range(n))
    assert below(math.ceil(K * (similarity - MARGIN) - 1e-9)) < 1e-7 and below(math.ceil(K * SHARED)) < 1e-7
