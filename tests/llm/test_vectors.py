"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from tidemark.llm import kmtree


def brute(rows, k, every):
    out = {}
    for i, q in rows:
        if i % every == 0:
            near = sorted((float(np.sqrt(((np.array(v) - np.array(q)) ** 2).sum())), j) for j, v in rows if j != i)[:k]
            out[i] = [(j, d) for d, j in near]
    return out


def search(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank", "3 as leaf", "4 as block")
    out = {}
    for r in kmtree.nearest_neighbours(df, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def vectors(n, d=8, seed=0):
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, d)))]


@pytest.mark.parametrize("block", [kmtree.BLOCK_ROWS, 60])
def test_recall_and_scores(spark, monkeypatch, block):
    monkeypatch.setattr(kmtree, "BLOCK_ROWS", block)
    rows = vectors(3000)
    got, want = search(spark, rows, every=50), brute(rows, 10, 50)
    assert got.keys() == want.keys()
    table = dict(rows)
    assert all(abs(s - np.sqrt(((np.array(table[q]) - np.array(table[v])) ** 2).sum())) < 1e-12 for q, found in got.items() for v, s in found)
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.9


def test_large_leaves_grow_subtrees(spark, monkeypatch):
    for name, value in {"FIT_ROWS": 200, "LEAF_ROWS": 30, "SPLIT_ROWS": 120, "BLOCK_ROWS": 100}.items():
        monkeypatch.setattr(kmtree, name, value)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 8)) * 6
    rows = [(i, [float(np.float32(x)) for x in centres[draw.integers(12) if i % 3 else 0] + draw.normal(size=8)]) for i in range(5000)]
    rows += [(i, [0.5] * 8) for i in range(5000, 6500)]
    split = []
    grow = kmtree._split
    monkeypatch.setattr(kmtree, "_split", lambda index, level: (split.append(grow(index, level)), split[-1])[1])
    got, want = search(spark, rows, every=50), brute(rows, 10, 50)
    assert got.keys() == want.keys() and all(len(f) == 10 for f in got.values())
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.9
    assert [v for v, _ in got[6000]] == list(range(5000, 5010)) and [v for v, _ in got[5000]] == list(range(5001, 5011))
    assert len(split) > 1 and split[0][1] is not None
    assert max(r["count"] for r in split[-1][0].groupBy("leaf").count().collect()) <= 120


def test_leaf_numbers_never_run_over(spark, monkeypatch):
    for name, value in {"FIT_ROWS": 400, "LEAF_ROWS": 30, "SPLIT_ROWS": 60, "BLOCK_ROWS": 100, "NUMBERS": 16, "LEVELS": 3}.items():
        monkeypatch.setattr(kmtree, name, value)
    draw = np.random.default_rng(7)
    for n in (20, 500, 4000):
        assert len(kmtree.Tree(draw.normal(size=(n, 5)), 8, 16).leaf_of) <= 16
    rows = vectors(4000, 6, 4)
    split = []
    grow = kmtree._split
    monkeypatch.setattr(kmtree, "_split", lambda index, level: (split.append(grow(index, level)), split[-1])[1])
    got, want = search(spark, rows, every=50), brute(rows, 10, 50)
    assert len([m for _, m in split if m is not None]) >= 2
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.9
    leaves = [r.leaf for r in split[-1][0].select("leaf").distinct().collect()]
    assert all(1 <= p - (q * 16 if q else 0) <= 16 for x in leaves for q, p in zip([0, *kmtree._path(x)], kmtree._path(x), strict=False))


def test_ties_and_copies_go_to_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(kmtree, "BLOCK_ROWS", 50)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 900, 3)] + [(i, v) for i, v in vectors(200, 3) if i % 3]
    got = search(spark, rows, every=100)
    assert [v for v, _ in got[300]] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27] and all(s == 0 for _, s in got[300])


def test_repeated_rows_of_a_query_hide_nobody(spark):
    rows = [(0, [1.0, 2.0])] * 20 + [(i, [1.0, 2.0]) for i in range(1, 6)] + [(7, [9.0, 9.0])] * 2
    got = search(spark, rows, every=100)
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5, 7, 7]


def test_few_rows_give_all_of_them(spark):
    rows = vectors(5)
    assert {q: [v for v, _ in f] for q, f in search(spark, rows, every=2).items()} == {q: [v for v, _ in f] for q, f in brute(rows, 10, 2).items()}


def test_unusable_vectors_take_no_part(spark):
    rows = vectors(30)
    bad = [(100, None), (101, [0.0] * 8), (102, [1.0, None] * 4), (103, [float("nan")] * 8), (104, [float("inf")] * 8), (105, [1.0]), (None, [1.0] * 8)]
    got = search(spark, rows + bad, every=5)
    assert all(v < 30 for f in got.values() for v, _ in f) and sorted(got) == list(range(0, 30, 5))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kmtree.nearest_neighbours(df).count() == 0
