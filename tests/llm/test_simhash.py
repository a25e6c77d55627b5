"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash

from .data import documents


def plain(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(id, print) -> least id reachable."""
    nodes = [(i, p) for i, p in rows if i is not None]
    least = {}
    component = {i: i for i, _ in nodes}
    changed = True
    while changed:
        changed = False
        for i, p in nodes:
            for j, q in nodes:
                if (i == j or (p ^ q).bit_count() <= 3) and component[i] != component[j]:
                    component[i] = component[j] = min(component[i], component[j])
                    changed = True
    least.update(component)
    return least


def test_fingerprints_against_plain_python():
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["a", "bb", "Ccc", "dé", "É"]) for _ in range(n)) for n in (0, 1, 2, 3, 4, 50, 700)]
    texts += [None, "", " \n", "A\tb\x0bc\x0cd", "a\x1cb c\x85d e f"]
    assert simhash.fingerprints(texts).tolist() == [plain(t) for t in texts]


def test_a_long_text_counts_whole():
    draw = random.Random(6)
    text = " ".join(draw.choice("abcdefghijklmnop") for _ in range(200_000))
    assert int(simhash.fingerprints(["x y z w", text, "q"])[1]) == plain(text)


def test_units_sum_up_and_cost_least():
    draw = np.random.default_rng(1)
    for m in simhash.PARTITIONS:
        price = draw.random((50, m, 5)) * 100
        price[:, :, 0] = 0
        units, cost = simhash.allocate(price)
        assert (units.sum(1) == 4).all()
        at = price[np.arange(50)[:, None], np.arange(m), units].sum(1)
        assert np.allclose(at, cost)
        from itertools import product

        for k in range(5):
            assert np.isclose(cost[k], min(sum(price[k, i, u] for i, u in enumerate(c)) for c in product(range(5), repeat=m) if sum(c) == 4))


def test_counts_at_a_distance():
    draw = np.random.default_rng(2)
    histogram = np.zeros((simhash.CELLS, 1 << simhash.CELL), np.int64)
    values = draw.integers(0, 1 << simhash.CELL, (simhash.CELLS, 300))
    for c in range(simhash.CELLS):
        np.add.at(histogram[c], values[c], 1)
    near = simhash.at_distance(histogram)
    for c in range(simhash.CELLS):
        for v in (0, 5, 65535, int(values[c][0])):
            apart = np.bitwise_count((values[c] ^ v).astype(np.uint64))
            assert near[c][:, v].tolist() == [int((apart == d).sum()) for d in range(4)]


def families(seed, n=60, of=12):
    """Fingerprints in families that differ in a few bits, one family large, some bits alike in all."""
    draw = random.Random(seed)
    out = set()
    for k in range(n):
        seed_bits = draw.getrandbits(64) & ~0xFFF
        for _ in range(of if k else of * 20):
            p = seed_bits
            for _ in range(draw.randint(0, 6)):
                p ^= 1 << draw.randrange(64)
            out.add(p)
    return sorted(out)


@pytest.mark.parametrize("partitions, block, small", [((4, 2), 4096, 4096), ((4,), 50, 20), ((2,), 4096, 4096), ((2,), 30, 1)])
def test_links_join_what_brute_force_joins(spark, monkeypatch, partitions, block, small):
    monkeypatch.setattr(simhash, "PARTITIONS", partitions)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(simhash, "SMALL", small)
    found = families(len(partitions) + block)
    signed = np.array(found, np.uint64).view(np.int64)
    links, order = simhash._links(spark.createDataFrame([(int(p),) for p in signed], "print long"), len(found))
    p = simhash.permuted(np.array(found, np.uint64), order)
    got = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links.collect()]

    def components(pairs):
        parent = {int(x): int(x) for x in p}

        def top(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in pairs:
            parent[top(a)] = top(b)
        groups = {}
        for x in parent:
            groups.setdefault(top(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    near = np.argwhere(np.triu(np.bitwise_count(p[:, None] ^ p) <= 3, 1))
    assert components(got) == components((int(p[i]), int(p[j])) for i, j in near)
    assert len(got) < 40 * len(p) < len(near) * 40  # no list of all pairs


def test_groups_of_odd_documents(spark, monkeypatch):
    draw = random.Random(9)
    words = [draw.choice(["red", "green", "blue", "Sun", "moon", "é"]) + str(draw.randrange(40)) for _ in range(400)]
    near = [(i, " ".join(w if draw.random() > 0.002 else "other" for w in words)) for i in range(200, 260)]
    rows = [*documents_rows(), *near]
    df = documents(spark, rows).withColumnsRenamed({}).selectExpr("*", "1 as print", "2 as component_id", "3 as node")
    got = simhash.simhash_groups(df).collect()
    want = [(i, plain(t)) for i, t in rows]
    assert sorted((str(r.doc_id), int(r.fingerprint, 16)) for r in got) == sorted((str(i), p) for i, p in want)
    assert all(len(r.fingerprint) == 16 for r in got)
    least = brute(want)
    assert all(r.component_id == (None if r.doc_id is None else least[r.doc_id]) for r in got)
    assert len({least[i] for i, _ in near}) < len(near)


def documents_rows():
    from .data import odd_documents

    return [*odd_documents(), (300, "x"), (300, "an id with two texts of another kind"), (301, "an id with two texts of another kind")]


def test_empty_table(spark):
    out = simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_all_texts_alike_or_blank(spark):
    rows = [(i, None) for i in range(5, 50)] + [(i, "the same text in many rows") for i in range(100, 300)]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[7] == ("0" * 16, 5) and got[299][1] == 100 and len(got) == len(rows)
