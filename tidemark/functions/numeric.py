"""Column builders for control points, and the cubic that goes through them.

Rounding is half to even throughout; arithmetic is in double.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Curvature limits of the tiers with 2 and 4 points; most points.
TAU_LOW, TAU_HIGH, MOST_POINTS = 0.005, 0.05, 8
#: The coded range.
LOW, SPAN, LEVELS = -2.0, 4.0, 255


def quantise(x: Column) -> Column:
    return F.least(F.greatest(F.rint((x - LOW) / SPAN * LEVELS), F.lit(0.0)), F.lit(float(LEVELS))).cast("bigint")


def dequantise(level: Column) -> Column:
    return level / F.lit(float(LEVELS)) * SPAN + LOW


def second_differences(xs: Column) -> Column:
    """|x[i-1] - 2 x[i] + x[i+1]| for the interior points."""
    return F.transform(F.sequence(F.lit(1), F.size(xs) - 2), lambda i: F.abs(F.get(xs, i - 1) - 2 * F.get(xs, i) + F.get(xs, i + 1)))


def curvature(xs: Column) -> Column:
    """Largest second difference; 0 for fewer than three points."""
    return F.when(F.size(xs) >= 3, F.array_max(second_differences(xs))).otherwise(F.lit(0.0))


def tier(curve: Column, low: float = TAU_LOW, high: float = TAU_HIGH) -> Column:
    return F.when(curve < low, 2).when(curve < high, 4).otherwise(MOST_POINTS)


def control_points(xs: Column, points: Column) -> Column:
    """Indices of both ends and the interior points of largest second difference, ``points`` in all; of equals the later one."""
    n = F.size(xs)
    ranked = F.array_sort(F.transform(second_differences(xs), lambda c, i: F.struct(c.alias("c"), (i + 1).alias("i"))))
    best = F.slice(F.reverse(ranked), F.lit(1), F.greatest(points - 2, F.lit(0)))
    inner = F.when(n >= 3, F.transform(best, lambda s: s.i)).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_union(F.array(F.lit(0), n - 1), inner))


def pchip(t: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Monotone cubic through (t, y), t increasing, evaluated at ``at``; constant for one point, a line for two."""
    return pchip_rows(t, np.asarray(y, float)[None], at)[0]


def pchip_rows(t: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``pchip`` of many curves with the same knots, a row of ``y`` each."""
    t, y, at = np.asarray(t, float), np.asarray(y, float), np.asarray(at, float)
    if len(t) == 1:
        return np.repeat(y, len(at), 1)
    h, d = np.diff(t), np.diff(y, axis=1) / np.diff(t)
    if len(t) == 2:
        return y[:, :1] + d * (at - t[0])
    m = np.zeros_like(y)
    w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        m[:, 1:-1] = np.where(d[:, :-1] * d[:, 1:] > 0, (w1 + w2) / (w1 / d[:, :-1] + w2 / d[:, 1:]), 0)

    def end(h0: float, h1: float, d0: np.ndarray, d1: np.ndarray) -> np.ndarray:
        slope = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
        steep = (d0 * d1 <= 0) & (np.abs(slope) > 3 * np.abs(d0))
        return np.where(slope * d0 <= 0, 0.0, np.where(steep, 3 * d0, slope))

    m[:, 0], m[:, -1] = end(h[0], h[1], d[:, 0], d[:, 1]), end(h[-1], h[-2], d[:, -1], d[:, -2])
    k = np.clip(np.searchsorted(t, at, "right") - 1, 0, len(h) - 1)
    s, h = (at - t[k]) / h[k], h[k]
    return (1 + 2 * s) * (1 - s) ** 2 * y[:, k] + s * (1 - s) ** 2 * h * m[:, k] + s * s * (3 - 2 * s) * y[:, k + 1] + s * s * (s - 1) * h * m[:, k + 1]
