"""Poses in numpy: joint mapping, cleaning, windows and control-point tokens.

Arrays are (frames, 17, 3) with NaN for what is missing.  ``poseframes`` runs
these steps over tracks of any length in Spark.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import LEVELS, LOW, MOST_POINTS, SPAN, TAU_HIGH, TAU_LOW, pchip

#: The joints in order.
JOINTS = ("pelvis", "r_hip", "r_knee", "r_ankle", "l_hip", "l_knee", "l_ankle", "spine", "thorax", "nose", "head_top", "l_shoulder", "l_elbow", "l_wrist", "r_shoulder", "r_elbow", "r_wrist")
#: Fixed values: (parent, child, length) of the skeleton's bones, parents first.
BONES = (
    (0, 1, 0.2), (1, 2, 0.45), (2, 3, 0.45), (0, 4, 0.2), (4, 5, 0.45), (5, 6, 0.45), (0, 7, 0.3), (7, 8, 0.3),
    (8, 9, 0.2), (9, 10, 0.16), (8, 11, 0.2), (11, 12, 0.35), (12, 13, 0.3), (8, 14, 0.2), (14, 15, 0.35), (15, 16, 0.3),
)
#: The joint of the other order that each joint is copied from.
FROM_COCO = {1: 12, 2: 14, 3: 16, 4: 11, 5: 13, 6: 15, 9: 0, 11: 5, 12: 7, 13: 9, 14: 6, 15: 8, 16: 10}
#: Head top lies this far beyond the nose, seen from the thorax.
HEAD_RATIO = 0.8
#: Limits of the noise tests.
SHOULDER_RATIO, LONGEST_BONE, NEAREST_MEDIAN, PELVIS_JUMP = (0.1, 3.0), 2.5, 0.15, 0.5
MOST_SPEED, MOST_ACCELERATION, FOOT_MARGIN, BEND_LEAST = 150.0, 250.0, 0.1, -0.1


def map_joints(points: Column, least: float, binary: bool = True) -> Column:
    """17 joints of (coordinates..., confidence) in the other order to ours; those under ``least`` are null.

    Pelvis and thorax are midpoints, the spine is their midpoint, the head top
    is extrapolated.  ``binary`` confidences become 1, others are kept, those
    of midpoints being the smaller.
    """
    n = F.size(F.get(points, F.lit(0)))

    def joint(k: int) -> Column:
        p = F.get(points, F.lit(k))
        c = F.element_at(p, -1)
        return F.when(c >= least, F.concat(F.slice(p, F.lit(1), n - 1), F.array(F.lit(1.0) if binary else c)))

    def blend(a: Column, b: Column, at: float) -> Column:
        """a + at * (b - a), with the smaller confidence."""
        body = F.zip_with(F.slice(a, F.lit(1), n - 1), F.slice(b, F.lit(1), n - 1), lambda x, y: x + (y - x) * at)
        return F.when(a.isNotNull() & b.isNotNull(), F.concat(body, F.array(F.least(F.element_at(a, -1), F.element_at(b, -1)))))

    out: dict[int, Column] = {k: joint(src) for k, src in FROM_COCO.items()}
    out[0], out[8] = blend(joint(11), joint(12), 0.5), blend(joint(5), joint(6), 0.5)
    out[7] = blend(out[0], out[8], 0.5)
    nose = joint(0)
    head = F.zip_with(F.slice(nose, F.lit(1), n - 1), F.slice(out[8], F.lit(1), n - 1), lambda x, y: x + HEAD_RATIO * (x - y))
    out[10] = F.when(nose.isNotNull() & out[8].isNotNull(), F.concat(head, F.array(F.element_at(nose, -1))))
    return F.array(*[out[k] for k in range(17)])


def _norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(-1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / (_norm(x)[..., None] + 1e-8)


def resample(frames: np.ndarray, src: float, dst: float = 30.0) -> np.ndarray:
    """Linear in normalised time to max(2, round(n / src * dst)) frames; within 5 % of ``dst`` and under two frames it stays."""
    n = len(frames)
    if unchanged(n, src, dst):
        return frames
    m = max(2, round(n / src * dst))
    return between(frames, 0, n, m, np.arange(m))


def unchanged(n: int, src: float, dst: float = 30.0) -> bool:
    return n < 2 or abs(src / dst - 1) < 0.05


def between(frames: np.ndarray, first: int, n: int, m: int, at: np.ndarray) -> np.ndarray:
    """Frames ``at`` of the ``m`` that ``n`` are resampled to, from the ``frames`` that start with frame ``first``.

    Places are fractions of whole numbers, so they don't depend on how a track
    is cut.
    """
    k = np.minimum(at * (n - 1) // (m - 1), n - 2)
    s = ((at * (n - 1) - k * (m - 1)) / (m - 1)).reshape(-1, *[1] * (frames.ndim - 1))
    a, b = frames[k - first], frames[k + 1 - first]
    return np.where(s == 0, a, np.where(s == 1, b, a + (b - a) * s))


def resample_times(frames: np.ndarray, index: np.ndarray, src: float = 20.0, dst: float = 30.0) -> np.ndarray:
    """Linear in real time between frames with gaps in ``index``."""
    if len(frames) < 2:
        return frames
    t = np.asarray(index, float) / src
    return _at_times(frames, t, np.linspace(t[0], t[-1], max(2, round((t[-1] - t[0]) * dst) + 1)))


def _at_times(frames: np.ndarray, t: np.ndarray, at: np.ndarray) -> np.ndarray:
    k = np.clip(np.searchsorted(t, at, "right") - 1, 0, len(t) - 2)
    s = ((at - t[k]) / (t[k + 1] - t[k])).reshape(-1, *[1] * (frames.ndim - 1))
    return frames[k] + (frames[k + 1] - frames[k]) * s


def fill_gaps(frames: np.ndarray, most: int = 5) -> np.ndarray:
    """Missing runs of at most ``most`` frames, each coordinate alone: interpolated, at the ends the nearest value."""
    flat = frames.reshape(len(frames), -1).copy()
    at = np.arange(len(flat))
    for c in range(flat.shape[1]):
        ok = ~np.isnan(flat[:, c])
        if ok.all() or not ok.any():
            continue
        gap = np.diff(np.flatnonzero(np.r_[True, ok, True])) - 1
        length = np.repeat(gap, gap)
        fill = at[~ok][length <= most]
        flat[fill, c] = np.interp(fill, at[ok], flat[ok, c])
    return flat.reshape(frames.shape)


def smooth(frames: np.ndarray, width: int = 5) -> np.ndarray:
    """Mean over ``width`` frames of what is there, the ends repeated; missing values stay missing."""
    ok = ~np.isnan(frames)
    edge = [(width // 2, width // 2)] + [(0, 0)] * (frames.ndim - 1)
    total = np.pad(np.where(ok, frames, 0.0), edge, mode="edge")
    count = np.pad(ok.astype(float), edge, mode="edge")
    view = lambda x: np.lib.stride_tricks.sliding_window_view(x, width, axis=0).sum(-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(ok, view(total) / view(count), np.nan)


def normalise(frames: np.ndarray) -> np.ndarray:
    """Pelvis at the origin, bones of fixed lengths in the directions found."""
    out = np.zeros_like(frames)
    for parent, child, length in BONES:
        out[:, child] = out[:, parent] + _unit(frames[:, child] - frames[:, parent]) * length
    return out


def implausible(frames: np.ndarray) -> np.ndarray:
    """Frames that no body can make: all missing, odd shoulders, an overlong bone, or joints collapsed on the pelvis."""
    with np.errstate(invalid="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # slices without any value
        torso = _norm(frames[:, 0] - frames[:, 8]) + 1e-6
        ratio = _norm(frames[:, 14] - frames[:, 11]) / torso
        bones = np.stack([_norm(frames[:, c] - frames[:, p]) for p, c, _ in BONES], 1)
        spread = _norm(frames[:, 1:] - frames[:, :1])
        longest = np.where(np.isnan(bones).all(1), 0, np.nanmax(bones, 1))
        middle = np.where(np.isnan(spread).all(1), 0, np.nanmedian(spread, 1))
        return np.isnan(frames).all((1, 2)) | (ratio < SHOULDER_RATIO[0]) | (ratio > SHOULDER_RATIO[1]) | (longest > LONGEST_BONE * torso) | (middle < NEAREST_MEDIAN * torso)


def clean(frames: np.ndarray, fps: float = 30.0, vertical: int = 1, down: bool = True, legs: bool = True) -> np.ndarray:
    """A raw track to a centred, normalised and smoothed one; bad frames and joints become missing.

    Order: implausible frames, missing pelvis, jumps of the pelvis, bone
    lengths, smoothing, speed and acceleration limits, legs that bend the
    wrong way made straight along the spine.
    """
    q, bad = settled(frames)
    return limited(q, bad, median(reach(q)), fps, vertical, down, legs)


def settled(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The steps up to smoothing, and frames whose pelvis is missing or jumps: a frame depends on three before it and two after it."""
    p = frames.copy()
    p[implausible(p)] = np.nan
    no_root = (p[:, 0] == 0).all(-1)
    p[no_root] = np.nan
    jump = np.zeros(len(p))
    jump[1:] = _norm(p[1:, 0] - p[:-1, 0])
    bad = no_root | (jump > PELVIS_JUMP)
    p[jump > PELVIS_JUMP] = np.nan
    q = np.full_like(p, np.nan)
    q[~bad] = normalise((p - p[:, :1])[~bad])
    return smooth(q), bad


def reach(q: np.ndarray) -> np.ndarray:
    """Mean distance of each frame's joints from its pelvis; NaN where there are none."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # slices without any value
        return np.nanmean(_norm(q - q[:, :1]), 1) if len(q) else np.zeros(0)


def median(values: np.ndarray) -> float:
    there = values[~np.isnan(values)]
    return float(np.median(there)) if len(there) else np.nan


def limited(q: np.ndarray, bad: np.ndarray, span: float, fps: float = 30.0, vertical: int = 1, down: bool = True, legs: bool = True) -> np.ndarray:
    """The steps after smoothing, given the track's median reach ``span``: a frame depends on two before it."""
    if np.isnan(span) or span == 0:
        return np.full_like(q, np.nan)
    q = q.copy()
    with np.errstate(invalid="ignore"):
        v = np.full_like(q, np.nan)
        v[1:] = (q[1:] - q[:-1]) * fps
        a = np.full_like(q, np.nan)
        a[2:] = (v[2:] - v[1:-1]) * fps
        q[(_norm(v) / span > MOST_SPEED) | (_norm(a) / span > MOST_ACCELERATION)] = np.nan
        if legs:
            q = _straighten(q, span, vertical, -1.0 if down else 1.0)
    q[bad] = np.nan
    return q


def _straighten(q: np.ndarray, span: float, vertical: int, up: float) -> np.ndarray:
    """Legs with the foot above the pelvis or the knee bent the wrong way, laid along the spine."""
    out, hips, spine = q.copy(), _unit(q[:, 4] - q[:, 1]), _unit(q[:, 0] - q[:, 8])
    for hip, knee, ankle in ((4, 5, 6), (1, 2, 3)):
        thigh, calf = _unit(q[:, knee] - q[:, hip]), _unit(q[:, ankle] - q[:, knee])
        raised = up * (q[:, ankle, vertical] - q[:, 0, vertical]) > FOOT_MARGIN * span
        wrong = raised | ((np.cross(thigh, calf) * hips).sum(-1) < BEND_LEAST) | ((thigh * calf).sum(-1) < 0)
        upper, lower = (next(n for p, c, n in BONES if c == j) for j in (knee, ankle))
        out[wrong, knee] = q[wrong, hip] + spine[wrong] * upper
        out[wrong, ankle] = out[wrong, knee] + spine[wrong] * lower
    return out


def clean_mocap(frames: np.ndarray, confidence: np.ndarray, least: float = 0.3) -> np.ndarray:
    """Confidence gate, gap filling, centring and bone lengths, without the noise tests."""
    p = fill_gaps(np.where((confidence >= least)[..., None], frames, np.nan))
    return normalise(p - p[:, :1])


def centre_if_needed(frames: np.ndarray) -> tuple[np.ndarray, bool]:
    """Frames with the pelvis at the origin, and whether any coordinate is out of the coded range."""
    moved = frames - frames[:, :1] if np.nanmax(np.abs(frames[:, 0]), initial=0) >= 1e-4 else frames
    return moved, bool(np.nanmax(np.abs(moved), initial=0) > -LOW)


def hold(w: np.ndarray) -> np.ndarray:
    """Gaps of a window filled forward and then backward."""
    flat = pd.DataFrame(w.reshape(len(w), -1))
    return flat.ffill().bfill().to_numpy().reshape(w.shape)


def quantise(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((x - LOW) / SPAN * LEVELS), 0, LEVELS).astype(int)


def dequantise(level: np.ndarray) -> np.ndarray:
    return np.asarray(level, float) / LEVELS * SPAN + LOW


def control_indices(points: np.ndarray, low: float = TAU_LOW, high: float = TAU_HIGH) -> np.ndarray:
    """Frames kept of one joint: both ends and the interior ones of largest second difference, of equals the later."""
    n = len(points)
    bend = _norm(np.diff(points, 2, axis=0))
    curve = bend.max(initial=0)
    inner = 0 if curve < low else 2 if curve < high else MOST_POINTS - 2
    best = np.lexsort((np.arange(len(bend)), bend))[len(bend) - min(inner, len(bend)) :] + 1
    return np.unique(np.r_[0, best, n - 1])


def token_string(states: np.ndarray, fps: int = 30, pick: Callable[[np.ndarray], np.ndarray] = control_indices) -> tuple[str, dict[str, int]]:
    """A window as tokens, and the number of control points of each joint."""
    parts, counts = [f"<fps_{fps}>"], {}
    for j, name in enumerate(JOINTS):
        kept = pick(states[:, j])
        counts[name] = len(kept)
        coded = quantise(states[kept, j])
        parts.append(f"<{name}>")
        for t, xyz in zip(kept, coded, strict=True):
            parts.append(f"<{name}_t_{t}>")
            parts += [f"<{name}_{axis}_{v}>" for axis, v in zip("xyz", xyz, strict=True)]
        parts.append(f"</{name}>")
    return " ".join(parts), counts


_POINT = re.compile("|".join(rf"<({n})_t_(\d+)> *<{n}_x_(\d+)> *<{n}_y_(\d+)> *<{n}_z_(\d+)>" for n in sorted(JOINTS, key=len, reverse=True)))


def decode_tokens(text: str, least_frames: int = 8, times: int = 1) -> list[np.ndarray]:
    """Windows (frames, 17, 3) back from tokens, by the monotone cubic through each joint's points.

    Points that lack a coordinate are skipped; a joint with one point stands
    still, one without is at the origin.  ``times`` gives that many steps a
    frame.
    """
    out = []
    for part in re.split(r"<fps_\d+>", text)[1:] or [text]:
        joints: dict[str, dict[int, list[int]]] = {}
        for m in _POINT.finditer(part):
            name, t, *xyz = (g for g in m.groups() if g is not None)
            joints.setdefault(name, {}).setdefault(int(t), [int(v) for v in xyz])
        n = max([least_frames, *(t + 1 for points in joints.values() for t in points)])
        at = np.linspace(0, n - 1, (n - 1) * times + 1)
        w = np.zeros((len(at), 17, 3))
        for name, points in joints.items():
            t = np.array(sorted(points))
            xyz = dequantise([points[k] for k in t.tolist()])
            w[:, JOINTS.index(name)] = np.stack([pchip(t, xyz[:, d], at) for d in range(3)], 1)
        out.append(w)
    return out


def dense_tokens(states: np.ndarray, fps: int = 30) -> str:
    """Every coordinate of every joint and frame as a token."""
    coded = quantise(states)
    return " ".join([f"<fps_{fps}>", *(f"<joint_{j}_{a}_{coded[f, j, k]}>" for f in range(len(states)) for j in range(17) for k, a in enumerate("xyz"))])


def with_time(states: np.ndarray, window_id: int, fps: int = 30) -> np.ndarray:
    """(x, y, z, seconds) of every joint."""
    t = np.broadcast_to(((window_id + np.arange(len(states))) / fps)[:, None, None], (*states.shape[:2], 1))
    return np.concatenate([states, t], -1)


def pack_legacy(states: np.ndarray) -> dict[str, object]:
    """Anchor, scale and four frames coded in 8 bits, truncating; the frames are both ends and the two of largest mean second difference."""
    anchor = states[0]
    rel = states - anchor
    scale = float(np.abs(rel).max() + 1e-6)
    norm = rel / scale
    bend = _norm(np.diff(norm, 2, axis=0)).mean(1)
    picked = np.unique(np.clip(np.argsort(bend, kind="stable")[-2:] + 1, 1, len(states) - 2)).tolist()
    picked += [c for c in (2, 3, 4, 5) if c not in picked][: 2 - len(picked)]
    kept = np.array(sorted([0, *picked, len(states) - 1]))
    step = np.maximum(_norm(np.diff(norm, axis=0)).mean(1), 1e-5)
    arc = np.r_[0, np.cumsum(step)] / step.sum()
    return {"anchor": anchor, "scale": scale, "kept": kept, "arc": arc[kept], "tokens": ((np.clip(norm[kept], -1, 1) + 1) * 127.5).astype(np.uint8)}


#: Ranges of the coded scale and anchor.
SCALE_MAX, ANCHOR_RANGE = 2.0, 2.0


def legacy_tokens(package: dict[str, object]) -> list[int]:
    """A package as 256 numbers: scale, anchor (both rounded) and the coded points."""
    scale = np.rint(np.clip(package["scale"], 0, SCALE_MAX) / SCALE_MAX * 255)
    anchor = np.rint((np.clip(package["anchor"], -ANCHOR_RANGE, ANCHOR_RANGE) + ANCHOR_RANGE) / (2 * ANCHOR_RANGE) * 255)
    return [int(scale), *anchor.ravel().astype(int).tolist(), *np.asarray(package["tokens"]).ravel().astype(int).tolist()]


def unpack_legacy(package: dict, steps: int = 50) -> np.ndarray:
    """``steps`` frames along the arc from a legacy package."""
    points = (package["tokens"].astype(float) / 127.5 - 1) * package["scale"] + package["anchor"]
    at = np.linspace(0, 1, steps)
    flat = points.reshape(len(points), -1)
    return np.stack([pchip(package["arc"], flat[:, d], at) for d in range(flat.shape[1])], 1).reshape(steps, *points.shape[1:])


def first_seen(states: DataFrame) -> DataFrame:
    """Overlapping windows back to frames: of (track, window_id, states) the value of each frame and joint that the first window has."""
    f = states.select("track", "window_id", F.posexplode("states").alias("i", "joints"))
    f = f.select("track", "window_id", (F.col("window_id") + F.col("i")).alias("f"), F.posexplode("joints").alias("joint", "xyz"))
    whole = F.col("xyz").isNotNull() & F.forall("xyz", lambda v: v.isNotNull())
    return f.filter(whole).groupBy("track", "f", "joint").agg(F.min_by("xyz", "window_id").alias("xyz"))
