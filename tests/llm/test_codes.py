"""Vector codes and whitening against brute force."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import vectorcodes, whitening

BAD = [(9001, None, 1), (9002, [], 1), (9003, [1.0, None] * 8, 1), (9004, [float("nan")] * 16, 1), (9005, [float("inf")] * 16, 1), (9006, [1.0], 1)]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as x", "2 as code", "3 as before", "4 as error", "5 as n")


def vectors(n, d=16, seed=0, labels=3):
    draw = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in v], int(i % labels) or None) for i, v in enumerate(draw.normal(size=(n, d)) * draw.uniform(0.1, 2, d))]
    return rows


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows if v and all(c is not None and math.isfinite(c) for c in v) and len(v) == len(rows[0][1])]
    width = -(-len(kept[0][1]) // parts)
    cut = [[([*v, *[0] * (parts * width)][j * width : (j + 1) * width]) for j in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[list(cut[k][j]) for k in first] for j in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, j: min((far(v, e), k) for k, e in enumerate(books[j]))
    for _ in range(rounds):
        given = [[near(v[j], j)[1] for j in range(parts)] for v in cut]
        for j in range(parts):
            for k in range(len(first)):
                own = [cut[r][j] for r in range(len(cut)) if given[r][j] == k]
                if own:
                    books[j][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for (i, _, label), v in zip(kept, cut, strict=True):
        found = [near(v[j], j) for j in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    of = {}
    for _, _, e, label in out:
        of[label] = of.get(label, 0) + e
    return sorted(((i, c, e, of[label], digest) for i, c, e, label in out), key=str)


def codes(spark, rows, **how):
    return sorted((tuple(r) for r in vectorcodes.compress_vectors(table(spark, rows), **how).collect()), key=str)


@pytest.mark.parametrize("rows", [vectors(300), vectors(20, 32, 3), [*vectors(120, 20, 4), *vectors(40, 20, 4), (None, [0.5] * 20, None), (3, [9.0] * 20, 7)], [(i, [1.0] * 16, None) for i in range(200)]])
def test_codes_against_brute_force(spark, rows):
    assert codes(spark, [*rows, *BAD]) == brute_codes(rows)


def test_later_rounds_move_only_what_changes(spark, monkeypatch):
    rows = vectors(400, 16, 8)
    assert codes(spark, rows, rounds=5, entries=8) == brute_codes(rows, entries=8, rounds=5)
    draw = np.random.default_rng(1)
    parts, before, code = draw.integers(-99, 99, (50, 4, 2)), draw.integers(0, 5, (50, 4)), draw.integers(0, 5, (50, 4))
    before[:30] = code[:30]
    old, new = (vectorcodes.contributions(parts, None, c, 5) for c in (before, code))
    sums, counts = vectorcodes.contributions(parts, before, code, 5)
    assert (old[0] + sums == new[0]).all() and (old[1] + counts == new[1]).all()
    same = vectorcodes.contributions(parts[:30], before[:30], code[:30], 5)
    assert not same[0].any() and not same[1].any()


def test_large_components_stay_exact():
    parts = np.array([[[1 << 26, -(1 << 26)]], [[(1 << 26) - 1, 5]]])
    entries = np.array([[[-(1 << 26), 1 << 26], [(1 << 26) - 3, 7]]])
    code, error = vectorcodes.nearest(parts, entries)
    assert code.tolist() == [[1], [1]] and error.tolist() == [[9 + (7 + (1 << 26)) ** 2], [8]]


def test_no_usable_vector_gives_no_codes(spark):
    for rows in ([], BAD[:2]):
        out = vectorcodes.compress_vectors(table(spark, rows))
        assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def brute_whitening(rows, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in rows]
    fit = sorted({tuple(v) for _, v in kept})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    exact = np.array([[n * x - s for x, s in zip(v, total, strict=True)] for v in fit], np.float64) / n
    values, axes = np.linalg.eigh(exact.T @ exact / n)
    return kept, n, total, values[::-1][:components], axes[:, ::-1][:, :components], values.sum()


@pytest.mark.parametrize("rows", [vectors(300), [*vectors(150, 8, 2), *vectors(80, 8, 2), *[(i, [0.25] * 8, None) for i in range(500, 900)], (None, [1.5] * 8, 1)]])
def test_whitening_against_brute_force(spark, rows):
    kept, n, total, values, axes, trace = brute_whitening(rows)
    got = whitening.whiten(table(spark, [*rows, *BAD])).collect()
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    signs, by = {}, {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    for i, v in kept:
        for r in (r for r in by[i] if r.deviation == sum((n * x - s) ** 2 for x, s in zip(v, total, strict=True))):
            k = r.component - 1
            want = sum((n * x - s) / n * a for x, s, a in zip(v, total, axes[:, k], strict=True)) / math.sqrt(values[k])
            assert math.isclose(r.explained, values[k] / trace, rel_tol=1e-9)
            assert math.isclose(abs(r.whitened), abs(want), rel_tol=1e-7, abs_tol=1e-9)
            if abs(want) > 1e-6:
                signs.setdefault(k, set()).add(np.sign(r.whitened * want))
        assert {r.component for r in by[i] if r.deviation == sum((n * x - s) ** 2 for x, s in zip(v, total, strict=True))} == {1, 2, 3, 4}
    assert all(len(s) == 1 for s in signs.values())


def test_flat_directions_and_few_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)])).count() == 0
    got = whitening.whiten(table(spark, [(1, [0.0, 0.5], 1), (2, [1.0, 0.5], 1), (2, [1.0, 0.5], 1)])).collect()
    assert sorted((r.vec_id, r.component, r.deviation, abs(round(r.whitened, 12)), r.explained) for r in got) == [(1, 1, 256 * 256, 1.0, 1.0), (2, 1, 256 * 256, 1.0, 1.0), (2, 1, 256 * 256, 1.0, 1.0)]


def test_deviations_beyond_64_bits_are_null():
    out = whitening.deviations(np.array([[1 << 40], [3]]), [4], 2)
    assert out.tolist() == [None, 4]
