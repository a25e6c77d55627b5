"""Pose tracks of any length: a row is a frame, a window or a block of frames, never a track.

Frames are rows of ``track``, ``f`` (0, 1, ...) and ``xyz``, 51 doubles with
nulls for what is missing.  What looks at neighbouring frames gets blocks with
a halo: a block's frames and those just before and after it, which are dropped
once the block is done.  Frames cross to a worker as flat Arrow buffers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pchip_rows
from ..session import reach_workers, written
from . import pose
from .corpus import grouped_percentile
from .numbering import number_rows

WIDTH = 51
#: Frames of a block.
BLOCK = 4_096
#: Frames that a cleaned one depends on, before and after it: gaps of up to five and their ends, a jump, smoothing.
HALO = 9


def pose_frames(rows: DataFrame, track: Column, order: str, xyz: Column, **more: Column) -> DataFrame:
    """Frames of each track in ``order``, with ``more`` columns."""
    named = rows.select(track.cast("string").alias("track"), F.col(order).alias("_order"), xyz.alias("xyz"), *[c.alias(n) for n, c in more.items()])
    return number_rows(named, ["_order"], "f", ["track"]).select("track", F.col("f").cast("bigint").alias("f"), "xyz", *more)


def points_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of coordinates as (rows, frames, 17, 3), one frame to a row of WIDTH values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1, 17, 3)


def _lists(points: np.ndarray) -> pa.Array:
    flat = points.reshape(len(points), -1)
    values = pa.array(flat.ravel(), from_pandas=True)  # NaN becomes null
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), values)


def map_frames(frames: DataFrame, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``fn`` over frames, each by itself."""
    reach_workers(frames.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(fn(points_of(b.column(2))[:, 0]))], names=["track", "f", "xyz"])

    return frames.select("track", "f", "xyz").mapInArrow(run, "track string, f bigint, xyz array<double>")


def frame_flags(frames: DataFrame, test: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``track``, ``f``, ``flag``: what ``test`` says of every frame."""
    reach_workers(frames.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(test(points_of(b.column(2))[:, 0]))], names=["track", "f", "flag"])

    return frames.select("track", "f", "xyz").mapInArrow(run, "track string, f bigint, flag boolean")


def guarded(frames: DataFrame) -> DataFrame:
    """Tracks centred on the pelvis if it is not at the origin in all their frames."""
    away = frames.groupBy("track").agg(F.max(F.array_max(F.transform(F.slice("xyz", 1, 3), lambda v: F.abs(v)))).alias("away"))
    blocks = frames.select("track", F.floor(F.col("f") / BLOCK).alias("block")).distinct().join(away.filter(F.col("away") >= 1e-4), "track")
    root = F.slice("xyz", 1, 3)
    centred = F.transform("xyz", lambda v, i: v - F.get(root, i % 3))
    joined = frames.withColumn("block", F.floor(F.col("f") / BLOCK)).join(blocks, ["track", "block"], "left")
    return joined.select("track", "f", F.when(F.col("away").isNotNull(), centred).otherwise(F.col("xyz")).alias("xyz"))


def pose_windows(frames: DataFrame, width: int = 8, stride: int = 8) -> DataFrame:
    """Complete windows whose pelvis is there in every frame: ``track``, ``window_id`` and ``xyz`` of all frames, gaps filled forward and then backward."""
    starts = F.array_distinct(F.filter(F.array(*[F.floor(F.col("f") / stride) * stride - k * stride for k in range(-(-width // stride))]), lambda w: (w >= 0) & (F.col("f") - w < width)))
    each = frames.select("track", "f", "xyz", F.explode(starts).alias("window_id"))
    rooted = F.forall(F.slice("xyz", 1, 3), lambda v: v.isNotNull() & ~F.isnan(v))
    w = each.groupBy("track", "window_id").agg(F.array_sort(F.collect_list(F.struct("f", "xyz"))).alias("s"), F.count_if(rooted).alias("n"))
    flat = w.filter(F.col("n") == width).select("track", "window_id", F.flatten(F.transform("s", lambda x: x.xyz)).alias("xyz"))
    whole = F.forall("xyz", lambda v: v.isNotNull() & ~F.isnan(v))
    reach_workers(frames.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                filled = np.stack([pose.hold(x) for x in points_of(b.column(2))])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(filled)], names=["track", "window_id", "xyz"])

    return flat.filter(whole).unionByName(flat.filter(~whole).mapInArrow(run, "track string, window_id bigint, xyz array<double>"))


def _per_window(windows: DataFrame, fn: Callable[[np.ndarray], tuple], columns: str, kinds: list[pa.DataType]) -> DataFrame:
    """``fn``'s values for every window that has all its coordinates."""
    reach_workers(windows.sparkSession)
    names = ["track", "window_id", *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                made = list(zip(*map(fn, points_of(b.column(2))), strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(made, kinds, strict=True))], names=names)

    whole = windows.filter(F.forall("xyz", lambda v: v.isNotNull()))
    return whole.select("track", "window_id", "xyz").mapInArrow(run, f"track string, window_id bigint, {columns}")


def window_tokens(windows: DataFrame, fps: int = 30) -> DataFrame:
    """Control-point tokens: ``track``, ``window_id``, ``token_str``, ``cp_counts`` (by joint, in order)."""

    def one(w: np.ndarray) -> tuple:
        text, counts = pose.token_string(w, fps)
        return text, list(counts.values())

    return _per_window(windows, one, "token_str string, cp_counts array<int>", [pa.string(), pa.list_(pa.int32())])


def window_text(windows: DataFrame, render: Callable[[np.ndarray], str]) -> DataFrame:
    """``track``, ``window_id`` and in ``token_str`` what ``render`` makes of every window."""
    return _per_window(windows, lambda w: (render(w),), "token_str string", [pa.string()])


def window_packages(windows: DataFrame) -> DataFrame:
    """Legacy packages: ``track``, ``window_id``, the kept frames, their places along the arc, and the 256 coded numbers."""

    def one(w: np.ndarray) -> tuple:
        p = pose.pack_legacy(w)
        return [int(k) for k in p["kept"]], p["arc"].tolist(), pose.legacy_tokens(p)

    return _per_window(windows, one, "kept array<int>, arc array<double>, tokens array<int>", [pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32())])


def decoded(windows: DataFrame, times: int = 1) -> DataFrame:
    """``track``, ``window_id``, ``joint``, ``step``, ``x``, ``y``, ``z`` of every window's ``token_str``, at ``times`` steps a frame."""
    reach_workers(windows.sparkSession)
    names = ["track", "window_id", "joint", "step", "x", "y", "z"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for track, at, tokens in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for w in pose.decode_tokens(tokens, times=times):
                    step, joint = np.indices(w.shape[:2]).reshape(2, -1)
                    yield pa.RecordBatch.from_arrays([pa.array([track] * len(step)), pa.array([at] * len(step), pa.int64()), pa.array(joint), pa.array(step), *(pa.array(w[..., k].ravel()) for k in range(3))], names=names)

    return windows.select("track", "window_id", "token_str").mapInArrow(run, "track string, window_id bigint, joint bigint, step bigint, x double, y double, z double")


def sweep_errors(windows: DataFrame, counts: tuple[int, ...] = tuple(range(1, 9))) -> DataFrame:
    """``count``, ``track``, ``window_id``, ``joint``, ``error``: mean absolute error of what ``count`` evenly spaced coded points give back.

    All joints of a batch of windows go through one curve at a time: knots are
    the same for all.
    """
    reach_workers(windows.sparkSession)
    names = ["count", "track", "window_id", "joint", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            w = points_of(b.column(2))
            many, n = w.shape[:2]
            rows = w.transpose(0, 2, 3, 1).reshape(-1, n)  # by window, joint and axis
            for count in counts:
                kept = np.unique(np.rint(np.linspace(0, n - 1, count)).astype(int)) if count > 1 else np.array([0])
                back = pchip_rows(kept, pose.dequantise(pose.quantise(rows[:, kept])), np.arange(n))
                error = np.abs(rows - back).reshape(many, 17, -1).mean(2)
                at = np.repeat(np.arange(many), 17)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(many * 17, count)), b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(np.tile(np.arange(17), many)), pa.array(error.ravel())], names=names)

    return windows.select("track", "window_id", "xyz").mapInArrow(run, "count bigint, track string, window_id bigint, joint bigint, error double")


def sweep_report(windows: DataFrame, share: float = 0.95) -> DataFrame:
    """``count``, ``samples``, ``mean`` and ``high`` (the exact percentile ``share``) of the errors; no count's errors are held in one task."""
    errors = written(sweep_errors(windows), "sweep")
    means = errors.groupBy("count").agg(F.count("*").alias("samples"), F.avg("error").alias("mean"))
    return means.join(grouped_percentile(errors, "count", "error", share).withColumnRenamed("percentile", "high"), "count")


def static_joints(windows: DataFrame) -> DataFrame:
    """``windows``, ``straight`` (joints with two control points) and ``static`` (those whose coded first and last points agree), one row."""
    reach_workers(windows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                w = points_of(b.column(2))
                bend = np.sqrt((np.diff(w, 2, axis=1) ** 2).sum(-1)).max(1) if w.shape[1] > 2 else np.zeros((len(w), 17))
                straight = bend < pose.TAU_LOW
                same = (pose.quantise(w[:, 0]) == pose.quantise(w[:, -1])).all(-1)
                yield pa.RecordBatch.from_arrays([pa.array([len(w)]), pa.array([int(straight.sum())]), pa.array([int((straight & same).sum())])], names=["windows", "straight", "static"])

    each = windows.select("track", "window_id", "xyz").mapInArrow(run, "windows bigint, straight bigint, static bigint")
    return each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("windows", "straight", "static")])


def _dealt(frames: DataFrame, size: int, before: int, after: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Frames with the ``block`` they belong to, and again with those whose halo they are in."""
    f = F.col("f")
    blocks = F.array_distinct(F.array(F.floor(f / size), F.floor(F.greatest(f - after, F.lit(0)) / size), F.floor((f + before) / size)))
    return frames.select("track", F.explode(blocks).alias("block"), "f", "xyz", *extra)


def _of_block(dealt: DataFrame, fn: Callable[[str, int, np.ndarray, np.ndarray, pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``fn`` over each block: its track and number, its frames' numbers and points in order, and all columns."""
    reach_workers(dealt.sparkSession)
    empty = dealt.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("f")
        made = fn(table.column("track")[0].as_py(), table.column("block")[0].as_py(), table.column("f").to_numpy(), points_of(table.column("xyz"))[:, 0], table)
        return empty.empty_table() if made is None else made.cast(empty)

    return dealt.groupBy("track", "block").applyInArrow(run, schema)


def resampled(frames: DataFrame, src: float, dst: float = 30.0, size: int = BLOCK) -> DataFrame:
    """Every track at ``dst`` frames a second, linear in normalised time; a block makes the frames between its own and the next one."""
    counts = frames.groupBy("track").agg(F.count("*").alias("n"))
    counted = _with_track(_dealt(frames, size, 0, 1), counts)

    def make(track: str, block: int, f: np.ndarray, points: np.ndarray, table: pa.Table) -> pa.Table | None:
        n = table.column("n")[0].as_py()
        low, high = block * size, min((block + 1) * size, n)
        if low >= n:
            return None
        if pose.unchanged(n, src, dst):
            at, new = f[f < high], points[f < high]
        else:
            m = max(2, round(n / src * dst))
            ends = [-(-k * (m - 1) // (n - 1)) for k in (low, min(high, n - 1))]
            at = np.arange(ends[0], m if high == n else ends[1])
            if not len(at):
                return None
            new = pose.between(points, int(f[0]), n, m, at) if f[0] <= low - 1 or len(points) > 1 else np.repeat(points, len(at), 0)
        return pa.table({"track": pa.array([track] * len(at)), "f": pa.array(at), "xyz": _lists(new)})

    return _of_block(counted, make, "track string, f bigint, xyz array<double>")


def _with_track(dealt: DataFrame, of_track: DataFrame) -> DataFrame:
    """A value of each track joined on by block, so that no track fills one task."""
    blocks = dealt.select("track", "block").distinct().join(of_track, "track")
    return dealt.join(blocks, ["track", "block"])


def cleaned(frames: DataFrame, src_fps: float = 30.0, most_gap: int = 5, size: int = BLOCK, **how) -> DataFrame:
    """Every track resampled to 30 frames a second, filled and cleaned.

    Two passes: up to smoothing, in blocks with a halo; then, with the median
    reach of each track, the limits on speed and acceleration.
    """
    if most_gap > 5 or size < HALO:
        raise ValueError("the halo covers gaps of five frames, and a block must be no shorter")

    def settle(track: str, block: int, f: np.ndarray, points: np.ndarray, table: pa.Table) -> pa.Table | None:
        own = (f >= block * size) & (f < (block + 1) * size)
        if not own.any():
            return None
        q, bad = pose.settled(pose.fill_gaps(points, most_gap))
        reach = pa.array(pose.reach(q)[own], from_pandas=True)
        return pa.table({"track": pa.array([track] * int(own.sum())), "f": pa.array(f[own]), "xyz": _lists(q[own]), "bad": pa.array(bad[own]), "reach": reach})

    first = _of_block(_dealt(resampled(frames, src_fps, size=size), size, HALO, HALO), settle, "track string, f bigint, xyz array<double>, bad boolean, reach double")
    first = written(first, "settled")
    spans = grouped_percentile(first, "track", "reach", 0.5).withColumnRenamed("percentile", "span")
    dealt = _dealt(first, size, 2, 0, ("bad",))
    blocks = dealt.select("track", "block").distinct().join(spans, "track", "left")

    def limit(track: str, block: int, f: np.ndarray, points: np.ndarray, table: pa.Table) -> pa.Table | None:
        own = (f >= block * size) & (f < (block + 1) * size)
        if not own.any():
            return None
        span = table.column("span")[0].as_py()
        q = pose.limited(points, table.column("bad").to_numpy(), np.nan if span is None else span, **how)
        return pa.table({"track": pa.array([track] * int(own.sum())), "f": pa.array(f[own]), "xyz": _lists(q[own])})

    return _of_block(dealt.join(blocks, ["track", "block"]), limit, "track string, f bigint, xyz array<double>")


def cleaned_mocap(frames: DataFrame, least: float = 0.3, most_gap: int = 5, size: int = BLOCK) -> DataFrame:
    """Motion capture: frames with a ``confidence`` of each joint; joints under ``least`` go, gaps are filled, poses centred and given fixed bone lengths.

    None of the noise tests is made.  Blocks have a halo for the gaps.
    """
    if most_gap > 5 or size < HALO:
        raise ValueError("the halo covers gaps of five frames, and a block must be no shorter")
    gated = F.transform("xyz", lambda v, i: F.when(F.get("confidence", F.floor(i / 3).cast("int")) >= least, v))

    def clean(track: str, block: int, f: np.ndarray, points: np.ndarray, table: pa.Table) -> pa.Table | None:
        own = (f >= block * size) & (f < (block + 1) * size)
        if not own.any():
            return None
        p = pose.fill_gaps(points, most_gap)[own]
        return pa.table({"track": pa.array([track] * len(p)), "f": pa.array(f[own]), "xyz": _lists(pose.normalise(p - p[:, :1]))})

    return _of_block(_dealt(frames.withColumn("xyz", gated), size, HALO, HALO), clean, "track string, f bigint, xyz array<double>")


def unchanged_rate(fps: Column, target: float = 30.0, tolerance: float = 0.05) -> Column:
    """Whether a track of a frame rate is passed through by resampling: within ``tolerance`` of the target."""
    return F.abs(fps / target - 1) < tolerance
