"""Mixtures by target share."""

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.operators import mixture


@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 50), min_size=1), st.integers(0, 1000))
def test_quotas_sum_up_and_are_near(weights, total):
    if not sum(weights.values()):
        with pytest.raises(ValueError):
            mixture.quotas(weights, total)
        return
    q = mixture.quotas(weights, total)
    exact = {g: Fraction(total * w, sum(weights.values())) for g, w in weights.items()}
    assert sum(q.values()) == total and all(abs(q[g] - exact[g]) < 1 for g in q)


def test_quotas_of_equal_remainders():
    assert mixture.quotas({"b": 1, "a": 1, "c": 1}, 4) == {"b": 1, "a": 2, "c": 1}
    assert mixture.quotas({"a": 0.1, "b": 0.2}, 3) == {"a": 1, "b": 2}


@pytest.mark.parametrize("bins", [1, 8, mixture.BINS])
def test_counts_equal_quotas_on_any_partitioning(spark, monkeypatch, bins):
    monkeypatch.setattr(mixture, "BINS", bins)
    sizes = {"cut": 300, "same": 100, "more": 30, "one": 1, "none": 50, "other": 40}
    rows = [(f"{g}{i}", g) for g, n in sizes.items() for i in range(n)] + [("x", None)]
    weights = {"cut": 40, "same": 20, "more": 27, "one": 13, "none": 0}
    found = []
    for parts in (1, 7):
        d = spark.createDataFrame(rows, "id string, g string").repartition(parts)
        got = mixture.mixture(d, "id", "g", weights, 500).collect()
        assert Counter(r.g for r in got) == {g: q for g, q in mixture.quotas(weights, 500).items() if q}
        found.append(sorted(map(tuple, got)))
    assert found[0] == found[1]
    often = Counter(r[0] for r in found[0])
    assert {often[f"more{i}"] for i in range(30)} == {4, 5} and max(often[f"cut{i}"] for i in range(300)) == 1
    assert all([r[2] for r in found[0] if r[0] == k] == list(range(n)) for k, n in often.items())


def test_groups_without_rows(spark):
    d = spark.createDataFrame([("a", "x")], "id string, g string")
    with pytest.raises(ValueError, match="no rows of y"):
        mixture.mixture(d, "id", "g", {"x": 1, "y": 1}, 10)
    assert mixture.mixture(d, "id", "g", {"x": 1, "y": 0}, 3).count() == 3
    assert mixture.mixture(d, "id", "g", {"x": 1}, 0).count() == 0
    s = {r.g: (r.n, r.physical, r.target) for r in mixture.shares(d, "g", {"x": 1, "y": 3}).collect()}
    assert s == {"x": (1, 1.0, 0.25), "y": (0, 0.0, 0.75)}
