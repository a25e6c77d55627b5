"""Operators that compare documents, against brute force."""

import hashlib
import random

import pytest

from tidemark.llm import components, minhash, rlz

from .data import documents, odd_documents


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_groups(rows):
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t))
    low = {i: i for i in ids}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                low[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(draw, words, n):
    w = list(words)
    for _ in range(n):
        w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
    return " ".join(w)


def near_copies(seed=3):
    draw = random.Random(seed)
    rows, i = [], 1000
    for _ in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(30, 200))]
        for _ in range(draw.randint(1, 12)):
            rows.append((i, edited(draw, base, draw.randint(0, 4))))
            i += 3
    draw.shuffle(rows)
    return [(a, t.upper() if a % 2 else t) for a, t in rows] + odd_documents()


@pytest.mark.parametrize("bucket_rows", [minhash.BUCKET_ROWS, 2])
def test_groups_match_brute_force(spark, bucket_rows):
    rows = near_copies()
    want = brute_groups(rows)
    got = minhash.near_duplicates(documents(spark, rows), bucket_rows=bucket_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert sum(i != c for i, (_, c) in want.items()) > 20


def test_no_groups_in_an_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_links_at_exactly_three_quarters(spark):
    a = [f"w{i}" for i in range(11)]  # 7 shingles; 6 of 8 in common with b
    rows = [(1, " ".join(a)), (2, " ".join([*a[1:], "x"])), (3, " ".join([*a[2:], "x", "y"]))]
    assert brute_groups(rows) == {1: (7, 1), 2: (7, 1), 3: (7, 1)}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_pairs_with_one_common_band_in_a_large_bucket(spark, monkeypatch):
    def bands(values):  # all in one bucket, and nothing else in common
        import numpy as np

        return np.array([1, *(values[:31].view(np.int64) ^ values.view(np.int64).sum())])

    monkeypatch.setattr(minhash, "bands", bands)
    rows = [(2 * k + j, " ".join(f"w{k}x{i}" for i in range(20 + j))) for k in range(15) for j in range(2)]
    rows[0:2] = [(0, "some other words stand in this one"), (1, "and none of them in the next one")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows), bucket_rows=4).collect()}
    assert got == {i: c for i, (_, c) in brute_groups(rows).items()}
    assert sum(i != c for i, c in got.items()) == 14


def test_a_large_family_is_not_compared_in_pairs(spark, monkeypatch):
    """Documents that share 60 % of their shingles in pairs fill buckets but meet in none of the prefix lists; linked ones among them do."""
    draw = random.Random(5)
    core = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(core + [f"d{i}x{j}" for j in range(52)])) for i in range(300)]
    rows += [(1000 + i, " ".join(core + [f"d{i}x{j}" for j in range(49)] + [f"e{i}"] * 3)) for i in range(0, 300, 10)]
    draw.shuffle(rows)
    most = []
    meetings = minhash.meetings
    monkeypatch.setattr(minhash, "meetings", lambda lists, n: (most.append(meetings(lists, n)), most[0])[1])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows), bucket_rows=20).collect()}
    assert got == {i: c for i, (_, c) in brute_groups(rows).items()}
    blocks = most[0].groupBy("bucket").agg({"*": "count"}).collect()
    assert len(most) == 1 and max((r[1] for r in blocks), default=0) <= 4


@pytest.mark.parametrize("kept", [0, 150, minhash.KEPT_SHINGLES])
def test_nearly_similar_documents_are_no_pairs_to_confirm(spark, monkeypatch, kept):
    """Documents that share 72 % of their shingles in pairs pass the sketches; their bucket's task tells them apart, if their sets are at hand."""
    monkeypatch.setattr(minhash, "KEPT_SHINGLES", kept)
    draw = random.Random(9)
    core = [f"c{i}" for i in range(130)]
    rows = [(i, " ".join(core + [f"d{i}x{j}" for j in range(25)])) for i in range(60)]
    rows += [(100 + i, " ".join(core + [f"d{i}x{j}" for j in range(22)] + [f"e{i}"] * 3)) for i in range(0, 60, 4)]
    draw.shuffle(rows)
    asked = []
    confirm = minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda pairs, *x: (asked.append(pairs.count()), confirm(pairs, *x))[1])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute_groups(rows).items()}
    assert len(asked) == 2 and (asked[1] == 0) == (kept > 150)


def test_prefixes_lose_no_link(spark):
    draw = random.Random(6)
    rows = []
    for f in range(6):
        base = [f"f{f}w{i}" for i in range(draw.randint(8, 60))]
        rows += [(100 * f + i, edited(draw, base, draw.randint(0, 3)) + " tail" * draw.randint(0, 5)) for i in range(25)]
    sets = {i: shingles(t) for i, t in rows}
    lists = {}
    for r in minhash.prefixes(spark.createDataFrame(rows, "rep long, text string"), 5, 75).collect():
        lists.setdefault(r.bucket, {})[r.rep] = r.indexed
    met = set()
    for of in lists.values():
        for a in of:
            met |= {(a, b) for b in of if of[a] and (len(sets[a]), a) < (len(sets[b]), b)}
    for a in sets:
        for b in sets:
            if (len(sets[a]), a) < (len(sets[b]), b) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[a] != sets[b]:
                assert (a, b) in met


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 140)) and 200 not in got
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(rows, window):
    first, out = {}, {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), i)
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("hot_rows", [1, 20, rlz.HOT_ROWS])
@pytest.mark.parametrize(("window", "anchor"), [(10, 3), (50, 8)])
def test_spans_match_brute_force(spark, hot_rows, window, anchor):
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 40)))) for i in range(200, 300)]
    for i in range(300, 340):
        a, b = sorted(draw.sample(range(70), 2))
        rows.append((i, " ".join([f"u{i}"] * draw.randint(0, 3) + passage[a:b] + passage + [f"v{i}"])))
    rows = [r for r in odd_documents() if r[0] is not None] + rows
    got = rlz.substring_dedup(documents(spark, rows), window=window, anchor_words=anchor, hot_rows=hot_rows).collect()
    want = brute_spans(rows, window)
    assert len(got) == len(rows) and {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(v[1] for v in want.values()) > 1000


def test_null_ids_and_empty_tables(spark):
    rows = [(None, "a b c d e f g h i j k l"), (5, "a b c d e f g h i j k l"), (6, "a b c d e f g h i j k l")]
    got = {r.doc_id: r.n_removed for r in rlz.substring_dedup(documents(spark, rows), window=10, anchor_words=3).collect()}
    assert got == {None: 0, 5: 0, 6: 12}
    assert rlz.substring_dedup(documents(spark, [])).count() == 0


def test_factors_point_at_their_reference(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[20:80], "x", *words[5:60]]))]
    base = documents(spark, rows, clash=False).selectExpr("doc_id", "xxhash64(text) as row_key", "text")
    got = sorted((r.doc_id, r.start, r.length, r.ref_doc, r.ref_start) for r in rlz.duplicate_factors(base).collect())
    covered = {2: set()}
    for doc, start, length, ref, ref_start in got:
        assert (doc, ref) == (2, 1) and length >= 50
        assert rows[1][1].split()[start : start + length] == words[ref_start : ref_start + length]
        covered[2] |= set(range(start, start + length))
    assert covered[2] == set(range(60)) | set(range(61, 116))


@pytest.mark.parametrize("hot_rows", [1, rlz.HOT_ROWS])
def test_factors_are_maximal(spark, hot_rows):
    draw = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(base))]
    for i in range(2, 12):
        a, b = sorted(draw.sample(range(300), 2))
        rows.append((i, " ".join([f"u{i}", *base[a:b], f"v{i}", *base[:200], *base[a:b]])))
    text = {i: t.split() for i, t in rows}
    docs = documents(spark, rows, clash=False).selectExpr("doc_id", "xxhash64(text) as row_key", "text")
    got = rlz.duplicate_factors(docs, window=10, anchor_words=3, hot_rows=hot_rows).collect()
    assert len(got) > 20
    for r in got:
        own, ref = text[r.doc_id], text[r.ref_doc]
        assert r.length >= 10 and own[r.start : r.start + r.length] == ref[r.ref_start : r.ref_start + r.length]
        if r.ref_doc == 1:  # nothing before it could be the reference of a neighbouring window
            assert not r.start or not r.ref_start or own[r.start - 1] != ref[r.ref_start - 1]
            ends = r.start + r.length == len(own) or r.ref_start + r.length == len(ref)
            assert ends or own[r.start + r.length] != ref[r.ref_start + r.length]


def test_equal_hashes_do_not_make_a_factor(spark, monkeypatch):
    block = rlz.Block(3)
    monkeypatch.setattr(rlz, "roll", lambda hashes, n: hashes[: len(hashes) - n + 1] * 0)
    assert block.parse(1, 0, [b"a", b"b", b"c", b"d"]) == []
    assert block.parse(2, 5, [b"x", b"b", b"c", b"d", b"e"]) == [(6, 3, 1, 1)]


def test_texts_are_cut_and_other_columns_kept(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(w)), (2, "own words\n" + "  ".join(w) + " end"), (3, "left  as\nit is"), (4, None)]
    docs = documents(spark, rows).selectExpr("*", "cast(7 as bigint) as n_chars", "'x' as lang")
    out = rlz.without_duplicates(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars, r.lang) for r in out.collect()}
    assert got == {1: (rows[0][1], len(rows[0][1]), "x"), 2: ("own words end", 13, "x"), 3: ("left  as\nit is", 14, "x"), 4: (None, 7, "x")}
