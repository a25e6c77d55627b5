"""Operators that judge or encode each text alone, against brute force and the tokenizers library."""

import functools
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, pairwise, ranksync, repetition

from .data import documents, odd_documents

BYTE = str(public_tokenizers.path("byte_bpe_50k.json"))
WORD = str(public_tokenizers.path("word_bpe_49k.json"))


def base_measures(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


@given(st.text(alphabet="ab #|\n\té\x1c", max_size=200))
@settings(max_examples=300, deadline=None)
def test_base_measures(text):
    assert repetition.measure(text)[:6] == base_measures(text)


def verdict(text):
    """Shares of word characters in repeated n-grams and lines, and the verdict, counted with sets."""
    words = (text or "").encode().split()
    chars = sum(len(w.decode()) for w in words)
    shares = {}
    for n in repetition.MAX_NGRAM_SHARE:
        seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        inside = {i + j for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for j in range(n)}
        shares[n] = sum(len(words[i].decode()) for i in inside) / chars if chars else 0.0
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += sum(len(w.decode()) for w in line.encode().split()) if line in lines else 0
        lines.add(line)
    line_share = dup / chars if chars else 0.0
    high = any(shares[n] > m for n, m in repetition.MAX_NGRAM_SHARE.items()) or line_share > repetition.MAX_LINE_SHARE
    return not base_measures(text)[5] and not high, line_share


@given(st.lists(st.sampled_from(["ab", "cde", "f", "g\n", "ab cde f g\n", "é h", "x y z w v "]), max_size=80).map(" ".join))
@settings(max_examples=300, deadline=None)
def test_verdicts(text):
    got = repetition.measure(text)
    kept, line_share = verdict(text)
    assert bool(got[6]) == kept and abs(got[8] - line_share) < 1e-9


def test_repetition_on_odd_documents(spark):
    got = repetition.repetition_quality(documents(spark)).collect()
    want = sorted((repr(i), *base_measures(t)) for i, t in odd_documents())
    assert sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert {r.doc_id: r.kept for r in got}[105] is True
    assert repetition.keep_varied(documents(spark)).count() == sum(r.kept for r in got)
    assert repetition.repetition_quality(documents(spark, [])).count() == 0


def test_ngram_cover_is_exact_under_hash_collisions():
    ids = np.array([0, 1, 2, 0, 1, 3, 0, 1, 2])
    assert repetition._repeated(np.zeros(7, np.uint64), ids, 3).tolist() == [True, False, False, False, False, False, True]


PARTS = [*"abT e'sré1½ \n\t.,!\x1c\x85\xa0　漢😀￿́ß", "<|endoftext|>", "  ", "'re", " the"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)


@functools.cache
def byte_library():
    return Tokenizer.from_file(BYTE)


@given(TEXTS)
@settings(max_examples=500, deadline=None)
def test_ids_and_counts_are_the_librarys(text):
    want = byte_library()
    ids = want.encode(text, add_special_tokens=False).ids
    coded = bpe.load(BYTE).encode(text)
    assert np.frombuffer(coded, "<u4").tolist() == ids
    assert bpe.load(BYTE).decode(coded) == want.decode(ids, skip_special_tokens=False)
    assert ranksync.load(BYTE).count([text, text + " x"])[0] == len(ids)


def unbroken(n):
    draw = np.random.default_rng(n)
    return ["".join(map(chr, draw.integers(97, 123, n))), "a" * n, "".join(map(chr, draw.integers(0x4E00, 0x4F00, n // 3))), "the" * (n // 3), "x1" * (n // 2)]


@pytest.mark.parametrize("n", [200, 256, 300, 5000, 120_000])
def test_long_texts_without_a_space(n):
    want, coder, counter = byte_library(), bpe.load(BYTE), ranksync.load(BYTE)
    for text in unbroken(n):
        ids = want.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids
        assert counter.count([text, "b " + text]) == [len(ids), len(want.encode("b " + text, add_special_tokens=False).ids)]
    assert max(map(len, coder.pieces)) <= 64 and max(map(len, counter.pieces)) <= 64


@given(st.text(alphabet="abn'1 é", min_size=1, max_size=400))
@settings(max_examples=200, deadline=None)
def test_merging_alone_is_merging_together(word):
    counter = ranksync.load(BYTE)
    assert counter._alone(word.encode()) == counter._together([word.encode(), b"x"])[0]


@functools.cache
def word_library():
    return Tokenizer.from_file(WORD), packing.WordIds(WORD)


WORDY = [*"aZé'sİΣßǅ1²½_ .,!%#(\u0301\u0338\x1c\n<|>", "it's", "don't,", "Word%%%", "x.y...", "<|endoftext|>", "<|STARTOFTEXT|>", "ΟΔΟΣ", "'LL "]
#: Letters that composition takes apart, with marks behind them; and letters with neighbours that compose.
APART = [chr(c) for a, b in ((0x958, 0x95F), (0x9DC, 0x9DF), (0xA33, 0xA36), (0xA59, 0xA5E), (0xF43, 0xF69), (0xFB1D, 0xFB4E), (0x340, 0x344), (0x2126, 0x212B)) for c in range(a, b + 1)]


@given(st.lists(st.sampled_from(WORDY), max_size=40).map("".join))
@settings(max_examples=1500, deadline=None)
def test_word_ids_are_the_librarys(text):
    want, words = word_library()
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == want.encode(text, add_special_tokens=False).ids


@given(st.lists(st.one_of(st.sampled_from([*WORDY, " ", "क", "ন", "e"]), st.sampled_from(APART), st.characters(exclude_categories=["Cs"])), max_size=40).map("".join))
@settings(max_examples=4000, deadline=None)
def test_letters_that_fall_apart_keep_the_librarys_ids(text):
    want, words = word_library()
    assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == want.encode(text, add_special_tokens=False).ids


def test_every_letter_before_a_symbol():
    want, words = word_library()
    texts = [f"{c}? x{c}. {c}" for c in map(chr, range(0x20, 0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode(text, add_special_tokens=False).ids, ascii(text)


def test_unbroken_texts_pack_whole(library):
    words = packing.WordIds(WORD)
    for text in unbroken(3000):
        assert np.frombuffer(words.encode([text + " and " + text])[0], "<u4").tolist() == library[1].encode(text + " and " + text, add_special_tokens=False).ids
    assert max(map(len, words.words)) <= 64


def test_stale_queue_entries_and_caches_do_not_matter():
    coder = bpe.ByteBPE(BYTE)
    coder.pieces.limit = 1
    texts = ["banana bandana " * 5, "aaaaaaaaaaaaaaaaaaaaaaa", "x" * 1000]
    first = [coder.encode(t) for t in texts]
    coder.pieces.turn()
    coder.pieces.turn()
    assert [coder.encode(t) for t in texts] == first


def test_round_trip_on_odd_documents(spark, library):
    rows = odd_documents()
    got = bpe.bpe_round_trip(documents(spark), BYTE).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = library[0].encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library[0].decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert bpe.bpe_round_trip(documents(spark, []), BYTE).count() == 0
    back = bpe.decode_ids(bpe.encode_texts(documents(spark), BYTE), BYTE)
    assert sorted(repr(r.text) for r in back.collect()) == sorted(repr(t or "") for _, t in rows)


def test_counts_on_odd_documents(spark, library):
    got = sorted(repr(tuple(r)) for r in ranksync.count_tokens(documents(spark), BYTE).collect())
    want = []
    for i, t in odd_documents():
        n = len(library[0].encode(t or "", add_special_tokens=False).ids)
        want.append(repr((i, len((t or "").encode()), n, n > 1024)))
    assert got == sorted(want)
    assert ranksync.count_tokens(documents(spark, []), BYTE).count() == 0


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_plan_fills_sequences_without_overlap(histogram):
    plan = packing.plan_slots(histogram, 40)
    used = {}
    for length, n in histogram.items():
        rows = plan[plan[:, 0] == length]
        assert sum(rows[:, 2]) == n and rows[0, 1] == 0 and (rows[1:, 1] == np.cumsum(rows[:, 2])[:-1]).all()
        for _, _, count, base, each, offset in rows.tolist():
            for q in range(count):
                used.setdefault(base + q // each, []).append((offset + q % each * length, length))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 40
    total = sum(k * n for k, n in histogram.items())
    # every sequence but the last opened is more than half full, or its pieces are longer than half
    assert sum(sum(n for _, n in p) <= 20 for p in used.values()) <= 1
    assert len(used) >= -(-total // 40)


@pytest.mark.parametrize("together", [packing.RANKED_TOGETHER, 3])
def test_packing_on_odd_documents(spark, library, monkeypatch, together):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", together)
    got = packing.best_fit_pack(documents(spark), WORD, 256).collect()
    want = []
    for i, t in odd_documents():
        ids = np.array([*library[1].encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k // 256, k, len(ids[k : k + 256]), zlib.crc32(ids[k : k + 256].tobytes())) for k in range(0, len(ids), 256)]
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, want))
    at = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 256 and len(at) <= -(-sum(at.values()) // 256) + 1
    assert packing.best_fit_pack(documents(spark, []), WORD).count() == 0


def test_fit_prefers_the_better_side():
    draw = np.random.default_rng(0)
    good, bad = draw.normal(1, 1, (200, 3)), draw.normal(-1, 1, (200, 3))
    mean, scale, w, cut = pairwise.fit(good, bad)
    strength = lambda x: (x - mean) / scale @ w - cut
    assert (strength(good) >= 0).mean() > 0.9 and (strength(bad) < 0).mean() > 0.9


def test_classifier_on_odd_documents(spark):
    fine = [(1000 + i, f"The quick writers went over hill number {i}, and they told a calm story. It ended well.") for i in range(60)]
    poor = [(2000 + i, f"x%%% y$$$ | {i} | z### q&&& | w*** " * 5) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in fine] + [(i, 0, 0) for i, _ in poor] + [(9, None, 0), (None, 1, 0), (77777, 0, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, fine + poor + odd_documents())
    got = pairwise.quality_scores(docs, labels).collect()
    assert len(got) == 120 + len(odd_documents()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == 1 for i, _ in fine) and all(by[i].predicted == 0 for i, _ in poor)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert pairwise.keep_good(docs, labels).count() == sum(r.predicted for r in got)
    none = labels.filter("quality = 1")
    assert {r.score for r in pairwise.quality_scores(docs, none).collect()} == {0.5}
    assert pairwise.quality_scores(documents(spark, []), labels).count() == 0


def test_held_out_labels_do_not_matter(spark):
    rows = [(i, ("good plain words in a row, number %d." if i % 2 else "a%%%% b$$$ | %d |") % i) for i in range(90)]
    labels = [(i, i % 2, 0) for i in range(90)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 0) for i, q, _ in labels]
    frames = [spark.createDataFrame(x, "doc_id long, quality int, toxic int") for x in (labels, turned)]
    docs = documents(spark, rows, clash=False)
    a, b = (sorted(map(tuple, pairwise.quality_scores(docs, f).collect())) for f in frames)
    assert a == b


def test_fit_covers_every_pair():
    draw = np.random.default_rng(0)
    good, bad = draw.normal(0.3, 1, (300, 6)), draw.normal(-0.3, 1.3, (70, 6))
    mean, scale, w, cut = pairwise.fit(good, bad)
    both = np.vstack([good, bad])
    assert np.allclose(mean, both.mean(0), atol=1e-12) and np.allclose(scale, both.std(0), atol=1e-8)
    g, b = (np.clip((x - mean) / scale, -6, 6) for x in (good, bad))
    lost = 1 / (1 + np.exp((g @ w)[:, None] - b @ w))
    slope = (lost.sum(0) @ b - lost.sum(1) @ g) / lost.size + pairwise.DECAY * w
    assert np.abs(slope).max() < 2e-4
    right = lambda c: (g @ w >= c).sum() + (b @ w < c).sum()
    assert right(cut) >= max(map(right, np.concatenate([g @ w, b @ w]))) - 1  # the standardised features are rounded


def test_every_label_is_fitted_on(spark):
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(9000).filter("crc32(cast(id as string)) % 3 != 1").orderBy(F.xxhash64("id"), "id").collect()]
    told = {i: ("kind", 1) if k < 3100 else ("numbered", 1) if k < 4400 else ("poor", 0) for k, i in enumerate(ids)}
    text = {"kind": "calm words tell of a hill and its river", "numbered": "77 %%% a$$$ 88 | b### 99 q&&& 66", "poor": "xy %%% a$$$ zz | b### uv q&&& st"}
    rows = [(i, f"{text[kind]} {'so ' * (i % 7)}") for i, (kind, _) in told.items()]
    labels = spark.createDataFrame([(i, q, 0) for i, (_, q) in told.items()], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows, clash=False)
    found = [sorted(map(tuple, pairwise.quality_scores(docs.repartition(n), labels).collect())) for n in (1, 7)]
    assert [(i, p) for i, _, _, p in found[0]] == sorted((i, q) for i, (_, q) in told.items())
    assert found[0] == found[1]
    x = {i: pairwise.features(t) for i, t in rows}
    mean, scale, w, cut = pairwise.fit(*(np.array([x[i] for i, (_, q) in told.items() if q == side]) for side in (1, 0)))
    strength = np.clip((np.array([x[i] for i, *_ in found[0]]) - mean) / scale, -6, 6) @ w - cut
    assert np.allclose([s for _, _, s, _ in found[0]], 1 / (1 + np.exp(-strength)), atol=0.01)
