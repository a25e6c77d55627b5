"""Poses in blocks with a halo against whole tracks in numpy; dense numbers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.numeric import pchip, pchip_rows
from tidemark.operators import pose, poseframes
from tidemark.operators.numbering import number_rows


def raw_track(seed, n):
    draw = np.random.default_rng(seed)
    side = {1: (1, 0, 0), 4: (-1, 0, 0), 11: (-1, 0, 0), 14: (1, 0, 0)}
    base = np.zeros((17, 3))
    for p, c, length in pose.BONES:
        base[c] = base[p] + np.array(side.get(c, (0, 1 if c in (2, 3, 5, 6, 12, 13, 15, 16) else -1, 0.1))) * length
    a = base + 1.0 + draw.normal(size=(n, 17, 3)) * np.where(draw.random(n) < 0.1, 0.5, 0.02)[:, None, None]
    a[draw.random((n, 17)) < 0.03] = np.nan
    for at in draw.integers(0, max(1, n - 12), 4):
        a[at : at + draw.integers(3, 10), draw.integers(17)] = np.nan
    a[draw.random(n) < 0.03] += 0.7
    a[draw.random(n) < 0.02] = 0
    return a


def frame_rows(spark, tracks):
    rows = [(name, i, [None if np.isnan(v) else float(v) for v in f.ravel()]) for name, a in tracks.items() for i, f in enumerate(a)]
    return spark.createDataFrame(rows, "track string, f bigint, xyz array<double>")


def collected(df, names):
    out = {n: {} for n in names}
    for r in df.collect():
        assert r.f not in out[r.track]
        out[r.track][r.f] = np.array([np.nan if v is None else v for v in r.xyz]).reshape(17, 3)
    return {n: np.stack([f[i] for i in range(len(f))]) if f else np.zeros((0, 17, 3)) for n, f in out.items()}


TRACKS = {"long": 333, "a": 64, "b": 65, "c": 31, "two": 2, "one": 1, "nine": 9}


@pytest.mark.parametrize("src, size", [(24.0, 32), (24.0, 100_000), (30.0, 32), (60.0, 33), (20.0, 50)])
def test_blocks_give_what_whole_tracks_give(spark, src, size):
    tracks = {name: raw_track(k, n) for k, (name, n) in enumerate(TRACKS.items())}
    frames = frame_rows(spark, tracks)
    got = collected(poseframes.resampled(frames, src, size=size), tracks)
    for name, a in tracks.items():
        np.testing.assert_allclose(got[name], pose.resample(a, src), rtol=0, atol=1e-12)
    got = collected(poseframes.cleaned(frames, src, size=size), tracks)
    for name, a in tracks.items():
        want = pose.clean(pose.fill_gaps(pose.resample(a, src)))
        np.testing.assert_allclose(got[name], want, rtol=0, atol=1e-9, err_msg=name)
    assert 0.2 < np.isnan(got["long"]).mean() < 0.9


def test_no_row_is_longer_than_a_block(spark):
    frames = frame_rows(spark, {"t": raw_track(1, 500)})
    sizes = [r["count"] for r in poseframes._dealt(frames, 32, poseframes.HALO, poseframes.HALO).groupBy("track", "block").count().collect()]
    assert max(sizes) == 32 + 2 * poseframes.HALO
    with pytest.raises(ValueError, match="halo"):
        poseframes.cleaned(frames, most_gap=9)


def test_windows_and_tokens(spark):
    whole = pose.clean(raw_track(3, 60)[:, :, :])
    frames = frame_rows(spark, {"t": whole})
    for stride in (8, 2):
        got = {r.window_id: np.array(r.xyz, float).reshape(8, 17, 3) for r in poseframes.pose_windows(frames, 8, stride).collect()}
        want = {at: pose.hold(whole[at : at + 8]) for at in range(0, 53, stride) if not np.isnan(whole[at : at + 8, 0]).any()}
        assert got.keys() == want.keys()
        assert all(np.array_equal(got[k], want[k], equal_nan=True) for k in want)
    full = {k: w for k, w in want.items() if not np.isnan(w).any()}
    tokens = {r.window_id: (r.token_str, r.cp_counts) for r in poseframes.window_tokens(poseframes.pose_windows(frames, 8, 2)).collect()}
    assert tokens == {k: (pose.token_string(w)[0], list(pose.token_string(w)[1].values())) for k, w in full.items()}


def test_curves_of_many_rows_are_those_of_each():
    draw = np.random.default_rng(4)
    for k in range(1, 9):
        t = np.sort(draw.choice(20, k, replace=False))
        y, at = draw.normal(size=(30, k)), np.linspace(t[0], t[-1], 40)
        assert np.allclose(pchip_rows(t, y, at), [pchip(t, row, at) for row in y])
        assert np.allclose(pchip_rows(t, y, t), y)
    up = pchip_rows(np.arange(6), np.sort(draw.normal(size=(20, 6)), 1), np.linspace(0, 5, 200))
    assert (np.diff(up, axis=1) >= -1e-12).all()


def test_sweep_and_static_joints(spark):
    draw = np.random.default_rng(5)
    w = draw.normal(size=(3, 8, 17, 3)) * 0.4
    w[0] = w[0, :1]
    d = spark.createDataFrame([("t", k, x.ravel().tolist()) for k, x in enumerate(w)], "track string, window_id bigint, xyz array<double>")
    report = {r["count"]: r for r in poseframes.sweep_report(d).collect()}
    assert sorted(report) == list(range(1, 9)) and all(r.samples == 51 for r in report.values())
    coded = pose.dequantise(pose.quantise(w))
    assert report[8]["mean"] == pytest.approx(np.abs(coded - w).mean())
    assert report[1].high == pytest.approx(np.percentile(np.abs(coded[:, :1] - w).mean((1, 3)), 95))
    assert report[8].high <= report[4].high
    assert tuple(poseframes.static_joints(d).first()) == (3, 17, 17)
    assert tuple(poseframes.static_joints(d.limit(0)).first()) == (0, 0, 0)


def test_dense_numbers(spark):
    d = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("o"), F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 9 > 0, F.concat(F.lit("k"), F.col("id") % 5)).alias("k"))
    rows = d.collect()
    for parts in (1, 7):
        got = number_rows(d, ["o"], "n", ["k"], parts=parts).collect()
        want = {}
        for k in {r.k for r in rows}:
            want |= {(k, o): i for i, o in enumerate(sorted(r.o for r in rows if r.k == k))}
        assert {(r.k, r.o): r.n for r in got} == want and len(got) == len(rows)
        assert sorted(r.n for r in number_rows(d, ["o"], "n", first=5, parts=parts).collect()) == list(range(5, 1005))
    assert number_rows(d.limit(0), ["o"], "n").count() == 0


def test_legacy_tokens_have_256_numbers():
    tokens = pose.legacy_tokens(pose.pack_legacy(np.linspace(0, 1, 8)[:, None, None] * np.ones((8, 17, 3))))
    assert len(tokens) == 256 and all(0 <= t <= 255 for t in tokens)
