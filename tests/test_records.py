"""Operators on records, side streams, percentiles and splits, against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text, tokens
from tidemark.operators import corpus, flatten, intervals, records


def one(df):
    return df.first()[0]


def test_video_ids(spark):
    d = spark.createDataFrame([("a b.mp4", "T"), ("", "My Title"), (None, "X y z"), ("c.mp4.mp4", "")], "f string, t string")
    assert [r[0] for r in d.select(records.video_id(F.col("f"), F.col("t"))).collect()] == ["a b", "my_title", "x_y_z", "c"]


def test_activities_keep_their_place_among_those_left_out(spark):
    scene = (3, [([0.0, 2.0],), ([1.0],), ([5.0, 5.0],), ([2.0, 4.0, 9.0],), (None,)])
    d = spark.createDataFrame([("v", [scene])], "video_id string, scenes array<struct<scene_id:int,activities:array<struct<time_range:array<double>>>>>")
    assert [(r.activity_id, r.start, r.end) for r in records.explode_activities(d).collect()] == [("scene_3_act_1", 0, 2), ("scene_3_act_4", 2, 4)]


def test_reports_and_filters(spark):
    d = spark.createDataFrame([(1, "a", "x"), (2, " ", "y"), (3, None, "z"), (4, "cartoon dog", "z")], "id int, t string, g string")
    got = {r.g: (r.kept, r.dropped) for r in records.keep_report(d, records.filled("t"), ["g"]).collect()}
    assert got == {"x": (1, 0), "y": (0, 1), "z": (1, 1)}
    ids = spark.createDataFrame([(4,), (3,), (1,), (1,), (9,)], "id int")
    assert [r.id for r in records.listed_without(d, ids, "id", "t", r"(?i)\bcartoon\b").collect()] == [1, 3]
    assert [r[0] for r in records.left_over_keys(ids, d, "id").collect()] == [9]
    assert [r.id for r in records.nth_record(d, "g", "id", 2).collect()] == [4]


def test_parallel_arrays_and_spans(spark):
    d = spark.createDataFrame([(0, ["a", None], [1, 2]), (1, ["a"], [1, 2])], "i int, texts array<string>, images array<int>").withColumn("stem", F.lit("s"))
    assert [tuple(r) for r in records.parallel_records(d, "stem", "i", ["texts", "images"]).collect()] == [("s_0", 0, "a", 1), ("s_0", 1, None, 2)]
    s = spark.createDataFrame([(["a", None, "", "b"],), ([None],)], "t array<string>")
    assert [r[0] for r in s.select(records.joined_spans(F.col("t"))).collect()] == ["a\n\nb", None]


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ('{"text": "<seed2> <seed2_8191> </seed2>"}', (False, False, 0, 0)),
        ('{"text": "<seed2> <seed2_8192> <agent> </cosmos>"}', (False, False, 3, 1)),
        ('{"text": null}', (False, False, 0, 0)),
        ('{"id": 1}', (False, True, 0, 0)),
        ("[1]", (False, True, 0, 0)),
        ("{broken", (True, False, 0, 0)),
    ],
)
def test_text_errors(spark, line, want):
    assert tuple(one(spark.createDataFrame([(line,)], "l string").select(records.text_errors(F.col("l"))))) == want


def test_nested_json(spark):
    meta = '[{"params": "{\\"id\\": \\"abcdefghijk\\"}"}, {"params": "{\\"id\\": \\"short\\"}"}, {"params": "{bad"}, {"params": ""}]'
    d = spark.createDataFrame([(meta,), ("{bad",), (None,)], "m string")
    assert [r[0] for r in d.select(records.embedded_ids(F.col("m"))).collect()] == [["abcdefghijk"], [], []]
    r = spark.createDataFrame([(1, '{"a_token": [1, 2], "b_tokens": ["x"], "c_tokens": [1.5], "tokens": [1], "d_token": [], "e_token": 3}'), (2, "{bad")], "id int, r string")
    assert sorted(tuple(x) for x in records.token_arrays(r, "id", "r").collect()) == [(1, "a_token", 2), (1, "c_tokens", 1)]


def test_speech_split_and_wrapped_counts(spark):
    s = "<snac_1> <listen> <snac_2> <snac_3> </listen> <speak> <snac_4> </speak> <listen> <snac_5>"
    assert tuple(one(spark.createDataFrame([(s,)], "s string").select(tokens.speech_split(F.col("s"))))) == (5, 2, 1, 2)


def test_side_streams(spark):
    kinds = ["cosmos", "avc_lm", "avc_lm", "cosmos", "cosmos"]
    blocks = spark.createDataFrame([("t", i, k, str(i)) for i, k in enumerate(kinds)] + [("u", 0, "avc_lm", "0"), ("u", 1, "agent", "own")], "track string, pos long, kind string, payload string")
    sides = spark.createDataFrame([("t", i, f"a{i}", "" if i else "s0", None, f"c{i}") for i in range(4)] + [("u", 0, "a", "s", "w", "c")], "track string, chunk int, agent string, snac string, speech string, caption string")
    got = flatten.merge_sides(blocks, sides, "track").orderBy("track", "pos").collect()
    text_of = lambda t: [(r.kind, r.payload) for r in got if r.track == t]
    # no caption for the third cosmos block, as there is no third avc_lm block; no agent where the track has its own
    assert text_of("t") == [("caption", "c0"), ("cosmos", "0"), ("avc_lm", "1"), ("agent", "a0"), ("snac", "s0"), ("avc_lm", "2"), ("agent", "a1"), ("caption", "c1"), ("cosmos", "3"), ("cosmos", "4")]
    assert text_of("u") == [("avc_lm", "0"), ("snac", "s"), ("speech", "w"), ("agent", "own")]


def test_streams_are_parsed_in_one_pass(spark):
    s = "x <seed2> 1 </seed2> mid <caption>a <b> c</caption><agent></agent> <seed2>open"
    got = one(spark.createDataFrame([(s,)], "s string").select(tokens.parse_blocks(F.col("s"))))
    assert [tuple(b) for b in got] == [(0, "seed2", " 1 "), (1, "caption", "a <b> c"), (2, "agent", "")]


def test_snapping_rows_is_snapping_to_the_array(spark):
    draw = random.Random(3)
    chunks, rows = [], []
    for u in range(4):
        at = sorted(draw.randrange(60) for _ in range(40))
        chunks += [(u, i, float(at[8 * i]), float(at[8 * i + 7])) for i in range(5)]
        rows += [(u, 100 * u + k, draw.randrange(-5, 70) / 1.0) for k in range(60)]
    c = spark.createDataFrame(chunks, "u int, idx int, start double, end double")
    r = spark.createDataFrame(rows, "u int, id int, at double")
    got = {x.id: x.chunk for x in intervals.snap_rows(r, F.col("at"), c, "u").collect()}
    arrays = c.groupBy("u").agg(F.array_sort(F.collect_list(F.struct("idx", "start", "end"))).alias("cs"))
    want = {x.id: x.chunk for x in r.join(arrays, "u").select("id", intervals.snap_to_chunk(F.col("cs"), F.col("at")).alias("chunk")).collect()}
    spans = {(u, i): (a, b) for u, i, a, b in chunks}
    user = {i: u for u, i, _ in rows}
    for i, k in got.items():  # of overlapping chunks that contain the time the later may be taken
        assert k == want[i] or spans[user[i], k][0] <= next(a for _, j, a in rows if j == i) < spans[user[i], k][1]


@pytest.mark.parametrize("rounding", ["max1", "floor", "round"])
@pytest.mark.parametrize("ratio", [0.0, 0.13, 0.5, 1.0])
def test_split_takes_the_first_by_hash(spark, rounding, ratio):
    ids = [f"u{i}" for i in range(57)]
    rows = spark.createDataFrame([(i,) for i in ids] * 2, "k string")
    got = {r.k: r.split for r in corpus.split_units(rows, "k", ratio, "9", rounding).collect()}
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}|9".encode()).hexdigest()[:8], i))
    n = {"max1": max(1, int(57 * ratio)), "floor": int(57 * ratio), "round": round(57 * ratio)}[rounding]
    assert got == {i: "test" if k < n else "train" for k, i in enumerate(order)}
    assert corpus.split_units(rows.filter("k = ''"), "k", ratio, "9", rounding).count() == 0


@pytest.mark.parametrize("slices", [1, 5, 64])
def test_size_shards(spark, slices):
    draw = random.Random(1)
    rows = [(draw.randrange(10**6) if i % 2 else i, draw.randrange(1, 50)) for i in range(300)]
    rows = list(dict(rows).items())
    got = {r.o: r.shard for r in corpus.size_shards(spark.createDataFrame(rows, "o long, s long"), "o", "s", 200, slices).collect()}
    total, want = 0, {}
    for o, s in sorted(rows):
        want[o] = total // 200
        total += s
    assert got == want


@pytest.mark.parametrize("bins", [1, 7, 4096])
@pytest.mark.parametrize("share", [0.0, 0.37, 0.5, 0.95, 1.0])
def test_percentiles(spark, bins, share):
    draw = np.random.default_rng(2)
    groups = {0: draw.normal(size=101), 1: np.array([3.0]), 2: np.repeat([1.0, 2.0], 20), 3: np.r_[draw.normal(size=50), 1e6]}
    d = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [(0, None)], "g int, v double")
    got = {r.g: r.percentile for r in corpus.grouped_percentile(d, "g", "v", share, bins).collect()}
    assert got.keys() == groups.keys() and all(abs(got[g] - np.quantile(vs, share)) < 1e-9 * max(1, abs(got[g])) for g, vs in groups.items())


def test_repeated_ngrams(spark):
    d = spark.createDataFrame([(1, "the large dog ran and the large dog ran off"), (2, "a b c a b c"), (3, "only two"), (4, "")], "id int, t string")
    got = {}
    for r in corpus.drop_repeated_ngrams(d, "id", "t").orderBy("id", "at").collect():
        got.setdefault(r.id, []).append(r.word)
    assert got == {1: "the large dog ran and off".split(), 2: "a b c a b c".split(), 3: ["only", "two"]}
    w = spark.createDataFrame([(["a", "b", "c", "d"],)], "w array<string>")
    assert one(w.select(text.ngrams(F.col("w"), 3))) == ["a b c", "b c d"] and one(w.select(text.ngrams(F.col("w"), 3, last=False))) == ["a b c"]


def test_counted_ngrams_and_their_exchange(spark, monkeypatch):
    texts = ["a b c a b c", " a\tb\x0bc\x85d\u00a0e ", None, "", "x y", "\u00e9 \u00e9 \u00e9 \u00e9", "a b c"]
    d = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    for last, most in ((True, 1), (True, 100), (False, 1), (False, 100)):
        times, rows = Counter(), Counter()
        for t in texts:
            w = [x for x in re.split(r"[ \t\n\x0b\f\r]+", t or "") if x]
            grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2 - (not last))]
            times.update(grams)
            rows.update(set(grams))
        got = corpus.count_ngrams(d, "t", 3, last, most).collect()
        assert sorted(map(tuple, got)) == sorted((g, n, rows[g]) for g, n in times.items())
    # the more text there is, the more partitions the grams are dealt to
    one_task = spark.range(1000, numPartitions=1).select(F.concat_ws(" ", *[F.col("id") % k for k in range(2, 40)]).alias("t"))
    monkeypatch.setattr(corpus, "CHARS_A_SLICE", 1000)
    assert corpus.count_ngrams(one_task, "t", 3).rdd.getNumPartitions() > 50


def test_repeated_ngrams_need_no_exchange(spark):
    d = spark.createDataFrame([(1, "The this that the this that"), (2, "one two four\x85 one two four\x85 one two four\x85"), (3, None), (None, "aa bb cccc aa bb cccc dd")], "id bigint, t string")
    w = corpus.drop_repeated_ngrams(d, "id", "t", 3, ("that", "this"))
    assert "Exchange" not in w._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in w.collect():
        got.setdefault(r.id, []).append((r.at, r.word))
    words = {1: "The this that the this that", 2: "one two four\x85", None: "aa bb cccc dd"}
    assert {k: [x for _, x in sorted(v)] for k, v in got.items()} == {k: v.split(" ") for k, v in words.items()}
    assert [at for at, _ in sorted(got[None])] == [0, 1, 2, 6]


def test_images_and_punctuation(spark):
    page = '<img src="x/a.png"> <img src="x/a.png"> ![t](y/b.png) ![t](none.png)'
    d = spark.createDataFrame([(page,)], "t string")
    blocks = F.create_map(F.lit("a.png"), F.lit("A"), F.lit("b.png"), F.lit("B"))
    assert one(d.select(text.images_to_tokens(F.col("t"), blocks))) == " <BOI> A <EOI>   <BOI> A <EOI>   <BOI> B <EOI>  ![t](none.png)"
    d = spark.createDataFrame([(". it was um fine and so on .",)], "t string")
    assert one(d.select(text.punctuate(F.col("t")))) == "it was. fine and. So on."


def test_strict_counts_and_prefixes_raise(spark):
    d = spark.createDataFrame([("v", 3, 4)], "n string, a long, b long")
    with pytest.raises(Exception, match="v: found 3 blocks, expected 4"):
        d.select(tokens.strict_count(F.col("a"), F.col("b"), F.col("n"))).collect()
    p = spark.createDataFrame([("x", "c")], "p string, c string")
    with pytest.raises(Exception, match="no prefix fits v"):
        corpus.longest_prefix(d, "n", p, "p", "c", strict=True).collect()
