"""The pipeline's stages on a small table, each against its operator's brute force."""

import os
import random

import pytest

import corpus_pipeline
from tidemark.llm import repetition

from .test_groups import brute_groups, brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(4)
    text = lambda n: " ".join(f"w{draw.randrange(400)}" for _ in range(n)) + "."
    rows = [(i, text(120), "en", "s", 0) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " and one more word", "en", "s", 0) for i in range(10)]
    rows += [(200 + i, text(90) + " " + " ".join(rows[20][1].split()[:70]) + " " + text(60), "en", "s", 0) for i in range(5)]
    rows += [(300 + i, "bad%%% | word$$$ | " * 3 + " ".join(f"x{draw.randrange(900)}### |" for _ in range(60)), "en", "s", 0) for i in range(30)]
    rows += [(400, "too short", "en", "s", 0), (401, None, "en", "s", 0), (402, "again " * 400, "en", "s", 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 300), 0) for r in rows[:-3]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), stage(spark, docs, folder).schema)
        if k < 4:
            assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        kept.append(set(after))
        if k == 0:
            assert set(after) == {i for i, t in before.items() if repetition.measure(t)[6]}
        if k == 1:
            assert set(after) == {i for i in before if i < 300}
        if k == 2:
            assert set(after) == {i for i, (_, c) in brute_groups(list(before.items())).items() if i == c}
        if k == 3:
            want = brute_spans(list(before.items()), 50)
            assert all(len(after[i].text.split()) == want[i][0] - want[i][1] and after[i].n_chars == len(after[i].text) for i in before)
            assert sum(want[i][1] > 0 for i in before) == 5
        if k == 4:
            assert set(after) == set(before)
    assert corpus_pipeline.run(spark, folder).count() == len(docs.collect())


def test_near_dedup_keeps_rows_without_id_and_all_texts_of_an_id(spark):
    text = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    rows = [(None, text("a")), (None, text("a")), (1, text("b")), (7, text("c")), (7, text("d")), (7, text("d")), (8, text("d") + " end"), (9, text("e")), (9, text("b") + " end"), (9, text("e"))]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", len(t)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    seen = [(r.doc_id, r.text[0]) for r in got]
    assert seen.count((None, "a")) == 2 and {(1, "b"), (7, "c"), (9, "e")} <= set(seen)
    assert len(got) == 6 and sum(t == "d" for _, t in seen) == 1
    assert [r.source for r in got if r.text[0] == "e"] == ["s7"]
    assert corpus_pipeline.substring_dedup(spark, spark.createDataFrame(got, docs.schema), "").count() == 6


def odd_rows():
    """Nulls in every column, repeated rows, an id with several texts, a long text, and columns named like the operators' own."""
    draw = random.Random(7)
    text = lambda n: " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(900)}" for _ in range(n)) + "."
    plain = [(i, text(80)) for i in range(40)]
    rows = [*plain, (100, plain[3][1] + " end"), (101, plain[4][1]), (102, text(70) + " " + " ".join(plain[5][1].split()[:60])), (103, text(20_000))]
    rows += [(None, text(60)), (None, plain[6][1]), (None, None), (104, None), (105, ""), (7, plain[7][1]), (7, text(50)), (106, " ".join(plain[8][1].split()[:60]))]
    return [(i, t, None if k % 5 == 0 else "en", None, len(t or ""), k, "x") for k, (i, t) in enumerate(rows)]


ODD = "doc_id long, text string, lang string, source string, n_chars long, component_id int, score string"


def test_rows_in_and_out_of_each_stage_are_explained(spark, tmp_path):
    rows = odd_rows()
    labels = spark.createDataFrame([(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, ODD)
    key = lambda rs: sorted(map(repr, map(tuple, rs)))

    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and key(kept.collect()) == key(r for r in rows if repetition.measure(r[1])[6])
    good = corpus_pipeline.quality_classifier(spark, docs, str(tmp_path))
    assert key(good.collect()) == key(rows)  # no labels, nothing to reject

    near = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert near.columns == docs.columns
    got = near.collect()
    ids = [r for r in rows if r[0] is not None]
    apart, used = {}, {}  # each text of an id is a document of its own
    for r in ids:
        apart.setdefault((r[0], r[1]), []).append(r)
    numbers = {k: n for n, k in enumerate(sorted(apart, key=lambda k: (k[0], k[1] or "")))}
    groups = brute_groups([(numbers[k], k[1]) for k in apart])
    for k, n in numbers.items():
        used.setdefault(groups[n][1], []).append(k)
    null = [r for r in rows if r[0] is None]
    assert key(r for r in got if r.doc_id is None) == key(null)
    left = [(r.doc_id, r.text) for r in got if r.doc_id is not None]
    assert len(left) == len(set(left)) == len(used)
    assert all(sum(k in left for k in members) == 1 for members in used.values())
    assert {tuple(r) for r in got} <= set(rows)

    cut = corpus_pipeline.substring_dedup(spark, near, str(tmp_path))
    assert cut.columns == docs.columns
    after = cut.collect()
    assert len(after) == len(got)
    want = brute_spans([(r.doc_id, r.text) for r in got if r.doc_id != 7], 50)
    for r in after:
        if r.doc_id not in (None, 7):
            assert len((r.text or "").split()) == want[r.doc_id][0] - want[r.doc_id][1]
    assert any(v[1] for v in want.values())
    packed = corpus_pipeline.packing(spark, cut, str(tmp_path)).collect()
    assert sum(r.piece == 0 for r in packed) == len(after)


def test_empty_table(spark, folder, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").filter("doc_id < 0").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_registered_queries_run_over_whole_tables(spark):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    for n in ("op1_repetition", "op6_bpe", "op9_tokens", "op10_substrings"):
        assert entry.queries()[n](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
