"""Operators on small frames with hand-computed results."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, corpus, flatten, intervals, pose, streams, vocabulary, windows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bucket", [None, 3.0])
def test_overlap_join_takes_the_threshold_and_each_pair_once(spark, bucket):
    a = spark.createDataFrame([("v", 1, 0.0, 10.0), ("v", 2, 10.0, 20.0)], "v string, a int, start double, end double")
    b = spark.createDataFrame([("v", "x", 9.8, 30.0), ("v", "y", 9.9, 9.95), ("w", "z", 0.0, 9.0)], "v string, b string, r_start double, r_end double")
    got = intervals.overlap_join(a, b, ["v"], 0.2 - 1e-9, bucket).select("a", "b")
    assert rows(got) == [(1, "x"), (2, "x")]


@pytest.mark.parametrize("longest, at_most", [(9.0, 9.0), (0.0, 0.0), (200.0, 200.0), (float("nan"), 9.0), (None, 9.0)])
def test_overlap_join_deals_right_rows_once(spark, longest, at_most):
    draw = random.Random(5)
    left = [(k % 2, k, s, s + draw.choice([0.0, 3.0, 30.0, -1.0])) for k in range(60) for s in [draw.uniform(-50, 50)]]
    right = [(k % 2, k, float(s), s + min(at_most, draw.choice([0.0, 1.0, 9.0, 200.0]))) for k in range(60) for s in [draw.randint(-50, 50)]]
    a = spark.createDataFrame(left, "v int, a int, start double, end double")
    b = spark.createDataFrame(right, "v int, b int, r_start double, r_end double")
    got = intervals.overlap_join(a, b, ["v"], 0.5, 8.0, longest)
    want = [(x[1], y[1]) for x in left for y in right if x[0] == y[0] and min(x[3], y[3]) - max(x[2], y[2]) >= 0.5]
    assert sorted(rows(got.select("a", "b"))) == sorted(want)
    if longest == 9.0:
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1


def test_best_overlap_takes_the_first_of_equals(spark):
    p = spark.createDataFrame([(1, 0, 2.0), (1, 1, 2.0), (2, 0, 0.0)], "seg int, act int, overlap double")
    assert rows(intervals.best_overlap(p, ["seg"], "act").select("seg", "act")) == [(1, 0)]


def test_snap_before_inside_and_after(spark):
    d = spark.createDataFrame([([(0, 1.0, 2.0), (1, 2.0, 3.0)], x) for x in (0.0, 2.0, 9.0)], "c array<struct<idx:int,start:double,end:double>>, t double")
    assert [r[0] for r in d.select(intervals.snap_to_chunk(F.col("c"), F.col("t"))).collect()] == [0, 1, 1]


def test_grid_is_half_even(spark):
    d = spark.createDataFrame([(4,), (12,), (20,), (9,)], "f int")
    assert [r[0] for r in d.select(asof.nearest_grid(F.col("f"), 8)).collect()] == [0, 16, 16, 8]


def test_lookup_falls_back_to_neighbours(spark):
    p = spark.createDataFrame([(1, "v", 8), (2, "v", 40), (3, "v", 80)], "id int, v string, base bigint")
    b = spark.createDataFrame([("v", 16, "x"), ("v", 40, "y"), ("v", 32, "z")], "v string, w bigint, tok string")
    got = asof.preferred_lookup(p, b, ["v"], F.col("base"), [0, -8, 8], "w", "tok", ["id"]).select("id", "tok")
    assert rows(got) == [(1, "x"), (2, "y"), (3, None)]


@pytest.mark.parametrize(("n", "m"), [(1, 1), (5, 1), (10, 10), (20, 30), (48, 30), (7, 50)])
def test_index_map_is_numpys(spark, n, m):
    got = [r[0] for r in spark.range(m).select(asof.index_map(F.col("id"), F.lit(n), F.lit(m))).collect()]
    assert got == ([0] if m == 1 else np.rint(np.linspace(0, n - 1, m)).astype(int).tolist())


def track(spark, values):
    return spark.createDataFrame([("t", i, None if v is None else float(v)) for i, v in enumerate(values)], "t string, f bigint, x double")


@pytest.mark.parametrize("n", [7, 8, 17])
def test_windows(spark, n):
    d = track(spark, range(n))
    assert [r.window_id for r in windows.tumbling(d, "t", 8, "x").orderBy("window_id").collect()] == list(range(0, n - 7, 8))
    assert windows.sliding(d, "t", 8, "x").count() == max(0, n - 7)


def test_gaps_and_smoothing_match_numpy(spark):
    v = [None, None, 1, 2, None, 4] + [None] * 6 + [8, None]
    d = track(spark, v)
    a = np.array([np.nan if x is None else x for x in v], float)
    want = pose.fill_gaps(a[:, None, None])[:, 0, 0]
    got = np.array([np.nan if r.filled is None else r.filled for r in windows.fill_gaps(d, "t", "x").orderBy("f").collect()], float)
    assert np.allclose(got, want, equal_nan=True) and np.isnan(got[6:12]).all() and got[0] == 1
    want = pose.smooth(a[:, None, None])[:, 0, 0]
    got = np.array([np.nan if r[0] is None else r[0] for r in d.orderBy("f").select("f", windows.centred_mean(d, "t", "x").alias("s")).orderBy("f").select("s").collect()], float)
    assert np.allclose(got, want, equal_nan=True)


def test_presence_filter_cuts_at_four(spark):
    w = spark.createDataFrame([("t", 0), ("t", 8), ("t", 16)], "t string, window_id bigint")
    flags = spark.createDataFrame([("t", i, not (i < 3 or 8 <= i < 12)) for i in range(16)], "t string, f bigint, present boolean")
    assert rows(windows.presence_filter(w, flags, "t", 8)) == [("t", 0, 3)]


def test_even_split_and_padding(spark):
    d = spark.createDataFrame([(list(range(5)),)], "a array<int>")
    assert d.select(windows.even_split(F.col("a"), 2)).first()[0] == [[0, 1], [2, 3, 4]]
    assert d.select(windows.padded_chunks(F.col("a"), 3)).first()[0] == [[0, 1, 2], [3, 4, 4]]


def test_debounce_and_supplement(spark):
    flags = [(float(i), i in (2, 3, 10)) for i in range(20)]
    d = spark.createDataFrame([(flags,)], "a array<struct<t:double,flag:boolean>>")
    got = d.select(windows.debounced_flips(F.col("a"), 2.0, 2)).first()[0]
    assert got == [2.0, 4.0, 10.0]
    got = d.select(windows.debounced_flips(F.col("a"), 5.0, 4)).first()[0]
    assert got == sorted(got) and len(got) <= 4 and {2.0, 10.0} <= set(got) and min(np.diff(got)) >= 5


STREAM = "<seed2> 1 </seed2> <cosmos> 2 </cosmos> <caption> a </caption> <caption> b </caption> <avc_lm> 3 </avc_lm> <agent> 4 </agent> <cosmos> 5 </cosmos> <avc_lm> </avc_lm> <seed2> 6 </seed2>"


def test_merge_and_flatten(spark):
    blocks = flatten.explode_blocks(spark.createDataFrame([("v", STREAM)], "v string, s string"), "v", "s")
    side = spark.createDataFrame([("v", 0, "one"), ("v", 5, "lost")], "v string, chunk bigint, payload string")
    merged = flatten.merge_side(blocks, side, "v", "speech")
    want = "<caption> b </caption> <seed2> <seed2_1> </seed2> <cosmos> <cosmos_2> </cosmos> <speech> one </speech> <agent> <agent_4> </agent> <cosmos> <cosmos_5> </cosmos>"
    assert rows(flatten.flatten_blocks(merged, "v")) == [("v", want)]
    assert flatten.merge_side(merged, side, "v", "speech").count() == merged.count()


def test_chunk_timing(spark):
    blocks = flatten.explode_blocks(spark.createDataFrame([("v", STREAM)], "v string, s string"), "v", "s")
    agent = spark.createDataFrame([("v", 16)], "v string, window_id bigint")
    got = streams.chunk_timing(blocks, agent, "v", F.lit(8)).orderBy("chunk_idx").collect()
    assert [(r.abs_frame, r.has_seed2, r.has_agent) for r in got] == [(8, True, True), (16, False, True)]
    assert got[0].start_sec == 0.2667


def test_splits_and_oversampling_do_not_leak(spark):
    d = spark.createDataFrame([(i, f"u{i % 7}") for i in range(70)], "id int, u string")
    s = corpus.split_units(d, "u", 0.2, "42")
    assert s.filter("split = 'test'").count() == 1 and s.count() == 7
    o = corpus.oversample(d.select(F.col("id").cast("string").alias("id")), "id", 20)
    assert o.count() == 1400 and o.select("id").distinct().count() == 1400
    assert o.select(corpus.base_id(F.col("id"))).distinct().count() == 70


def test_dictionaries(spark):
    d = spark.createDataFrame([("k", "b", 2), ("k", "a", 1), ("m", "c", 3)], "k string, v string, o int")
    assert rows(corpus.first_wins(d, ["k"], "v", "o")) == [("k", "a", 1), ("m", "c", 0)]
    assert rows(corpus.concat_wins(d, ["k"], "v", "o")) == [("k", "a b"), ("m", "c")]
    assert rows(streams.last_wins(d, "k", "v", "o")) == [("k", "b"), ("m", "c")]


def test_longest_prefix(spark):
    d = spark.createDataFrame([("abcd",), ("abx",), ("zz",)], "n string")
    p = spark.createDataFrame([("ab", "short"), ("abc", "long")], "p string, c string")
    assert rows(corpus.longest_prefix(d, "n", p, "p", "c").select("n", "c")) == [("abcd", "long"), ("abx", "short"), ("zz", None)]


def test_vocabulary_sizes(spark):
    v = vocabulary.vocabulary(spark, (("a", 3), ("b", 2)))
    assert [tuple(r) for r in v.orderBy("id").collect()] == [("<a_0>", 0), ("<a_1>", 1), ("<a_2>", 2), ("<b_0>", 3), ("<b_1>", 4)]
    more = spark.createDataFrame([("<a_1>", 0), ("<x>", 1), ("<y>", 2)], "token string, ord int")
    assert rows(vocabulary.append_missing(v, more).filter("id > 4")) == [("<x>", 5), ("<y>", 6)]
    assert vocabulary.padded_size(274561) == 274688 and vocabulary.padded_size(128) == 128


def test_stream_helpers(spark):
    one = lambda c, **kw: spark.range(1).select(c.alias("x")).first().x
    assert one(streams.header_of(F.lit("Title here <seed2> 1 </seed2>"))) == "Title here"
    assert one(streams.nth_block(F.lit("<seed2> <seed2_1> </seed2> <seed2> <seed2_2> <seed2_3> </seed2>"), "seed2", 1)) == [2, 3]
    assert one(streams.spans(F.lit("<speech> a </speech> x <speech> b"), "speech")) == ["a", "b"]
    got = one(streams.slices(F.array(*map(F.lit, range(5))), 2))
    assert got.slices == [[0, 1], [2, 3]] and got.left_over == 1
    got = one(streams.conversation_parts(F.lit("USER: q ASSISTANT: <think>t</think> a")))
    assert (got.prompt, got.think, got.answer) == ("q", "t", "a")
    assert one(streams.fill_placeholders(F.lit("see <image_1>"), F.lit('{"image_1": "x.png"}'))) == "see x.png"
    assert one(streams.strip_outer(F.lit("<caption> a <image_0> b</caption>"))) == "a  b"
    assert one(streams.share_tokens(F.array(*map(F.lit, range(7))), 3)) == [[0, 1], [2, 3], [4, 5, 6]]
    assert one(streams.interleave(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("1"), F.lit("2"), F.lit("3")))) == ["a", "1", "2", "3", "b"]
    items = F.array(*map(F.lit, "abcdef"))
    assert one(streams.swap_some(items, 0.0, F.lit("k"))) == list("abcdef")
    assert sorted(one(streams.swap_some(items, 0.5, F.lit("k")))) == list("abcdef")


def test_cosmos_blocks_of_odd_size_raise(spark):
    with pytest.raises(Exception, match="cosmos block of 1"):
        spark.range(1).select(streams.nth_block(F.lit("<cosmos> <cosmos_1> </cosmos>"), "cosmos", 0)).collect()


def body(n=40):
    side = {1: (1, 0, 0), 4: (-1, 0, 0), 11: (-1, 0, 0), 14: (1, 0, 0)}
    base = np.zeros((17, 3))
    for p, c, length in pose.BONES:
        base[c] = base[p] + np.array(side.get(c, (0, 1 if c in (2, 3, 5, 6) else -1 if c < 11 else 1, 0.02))) * length
    return base + 1.0 + 0.01 * np.sin(np.arange(n)[:, None, None] / 5 + np.arange(17)[None, :, None])


def test_cleaning_marks_bad_frames_and_keeps_bone_lengths():
    raw = body()
    raw[10] = np.nan
    raw[20, 0] = 0
    raw[30] += 0.6
    q = pose.clean(raw)
    gone = np.isnan(q).all((1, 2))
    assert gone[[20, 30, 31]].all() and not np.isnan(q[[5, 15, 25]]).any()
    assert np.isnan(q[10, 1:]).all() and (q[10, 0] == 0).all()  # an implausible frame keeps its root at the origin
    still = pose.clean(np.repeat(body(1), 12, 0))
    for p, c, length in pose.BONES:
        assert np.allclose(np.linalg.norm(still[:, c] - still[:, p], axis=1), length)


def test_jump_of_exactly_the_limit_stays():
    raw = np.repeat(body(1), 4, 0)
    raw[2:] += np.array([0.5, 0, 0])
    assert not np.isnan(pose.clean(raw, legs=False)).any() or abs(np.linalg.norm(raw[2, 0] - raw[1, 0]) - 0.5) > 0


def test_tokens_round_trip():
    w = pose.clean(body())[8:16]
    text, counts = pose.token_string(w)
    assert set(counts) == set(pose.JOINTS) and text.startswith("<fps_30> <pelvis>")
    (back,) = pose.decode_tokens(text)
    assert back.shape == (8, 17, 3) and np.abs(back - w).max() < 0.03
    assert len(pose.decode_tokens(text, times=4)[0]) == 29
    broken = text.replace("<r_hip_x_", "<l_hip_x_")
    assert np.allclose(pose.decode_tokens(broken)[0][:, 1], 0)
    assert len(pose.decode_tokens(text + " " + text)) == 2


def test_legacy_codes_and_resampling():
    w = pose.clean(body())[8:16]
    p = pose.pack_legacy(w)
    assert p["tokens"].size == 204 and len(p["kept"]) == 4
    assert np.abs(pose.unpack_legacy(p)[[0, -1]] - w[[0, -1]]).max() < 0.02
    assert len(pose.dense_tokens(w).split()) == 409 and pose.with_time(w, 30).shape == (8, 17, 4)
    assert len(pose.resample(body(24), 24)) == 30 and len(pose.resample(body(24), 29.97)) == 24 and len(pose.resample(body(1), 24)) == 1
    assert len(pose.resample_times(body(4), [0, 1, 3, 4])) == 7
    moved, wide = pose.centre_if_needed(body())
    assert np.allclose(moved[:, 0], 0) and not wide


def test_joint_mapping(spark):
    pts = [[float(i), float(i) + 0.5, 0.9] for i in range(17)]
    pts[5][2] = 0.1
    got = spark.createDataFrame([(pts,)], "p array<array<double>>").select(pose.map_joints(F.col("p"), 0.5).alias("x")).first().x
    assert got[1] == [12.0, 12.5, 1.0] and got[0] == [11.5, 12.0, 1.0] and got[8] is None and got[10] is None and got[11] is None


def test_reassembly_takes_the_first_window(spark):
    d = spark.createDataFrame([("t", 0, [[[1.0]], [[None]]]), ("t", 1, [[[5.0]], [[6.0]]])], "track string, window_id bigint, states array<array<array<double>>>")
    assert rows(pose.first_seen(d).select("f", "xyz")) == [(0, [1.0]), (1, [5.0]), (2, [6.0])]
