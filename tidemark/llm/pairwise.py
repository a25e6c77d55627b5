"""Quality classifier by Bradley-Terry pairwise ranking.

Every labelled document that is not held out takes part: each pair of a good
and a bad one gives a feature difference, and logistic loss on all of them
learns one weight vector, whose product with a document's features is its
strength.  The quantile of all these strengths that tells most labels rightly
becomes the threshold, and the logistic function of the distance from it the
score.

Pairs are not written out.  A pass over the documents adds up counts, features
and their products by class and by bins of strength, whose number is bounded;
two bins stand for all pairs of their documents, by the strengths' means and
spread.  Features and weights lie on binary grids, so sums are exact and the
result does not depend on the order of rows or on partitions.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import WORD_SPACES, discard, map_rows, materialise

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

#: Weight decay, most passes over the documents, and the change of a weight under which they end.
DECAY, PASSES, NEAR = 1e-3, 40, 2.0**-9
#: Bins of strength: their least width while fitting and greatest number, and the greatest number for the threshold.
WIDTH, BINS, EDGES = 0.125, 1 << 10, 1 << 16
#: Steps of standardised features and of weights; standardised features end at LIMIT.
FEATURE_STEP, WEIGHT_STEP, LIMIT = 2.0**-10, 2.0**-16, 6.0
#: Grids of the parts in which features and their squares are added up, 20 bits each.
_PARTS = [2.0**e for e in (42, 22, 2, -18, -38, -58)]
#: Added to bin numbers, which then are positive.
_MIDDLE = 1 << 20

_DIGITS = b"0123456789"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#*$%&|<>"
_SOFT = b".,;:!?'\"()-"


def features(text: str | None) -> list[float]:
    """Numbers of one whole text; empty texts have all zeros but the first."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [1.0] + [0.0] * 21
    size = len(raw.translate(None, WORD_SPACES))

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))  # noqa: B905  the last word has no follower
    same = sum(c for (a, b), c in pairs.items() if a == b)
    top = max(counts.values())
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = raw.split(b"\n")
    ends = raw.count(b".") + raw.count(b"!") + raw.count(b"?")
    return [
        0.0,
        float(np.log(n)),
        1.0 / n,
        size / n,
        float(lengths.std()),
        float((lengths > 14).mean()),
        float((lengths == 1).mean()),
        share(_MARKS),
        min(1.0, 20 * share(_MARKS)),
        raw.count(b"|") / n,
        share(_DIGITS),
        share(_UPPER),
        share(_SOFT),
        ends / n,
        min(ends / n, 0.05),
        raw.count(b",") / n,
        len(counts) / n,
        len(pairs) / n,
        same / n,
        top / n,
        len(lines) / n,
        1.0 - len(set(lines)) / len(lines),
    ]


#: Keys and a row of numbers for each, to be added up by key over all documents.
Sums = tuple[np.ndarray, np.ndarray]
#: From the features (a row for each document) and labels (1 or 0) of some documents.
Measure = Callable[[np.ndarray, np.ndarray], Sums]


def _add_up(keys: np.ndarray, values: np.ndarray) -> Sums:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values[order], first, axis=0)


def _moments(x: np.ndarray, y: np.ndarray) -> Sums:
    """Sums of features and of their squares in parts; before them the numbers of all and of good documents."""
    rows = []
    for v in (x, x * x):
        for step in _PARTS:
            part = np.rint(v / step) * step
            rows.append(part.sum(0))
            v = v - part
    values = np.column_stack([np.zeros(len(rows)), rows])
    values[:2, 0] = len(y), y.sum()
    return np.arange(len(rows)), values


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.rint(np.clip((x - mean) / scale, -LIMIT, LIMIT) / FEATURE_STEP) * FEATURE_STEP


def _width(w: np.ndarray, least: float, bins: int) -> float:
    """Of a bin: a power of two, for ``bins`` bins at most."""
    return max(least, 2.0 ** math.ceil(math.log2(max(2 * LIMIT * np.abs(w).sum() / bins, 2.0**-26))))


def _by_bin(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, width: float) -> Measure:
    """For each class and bin of strength the number of documents, the sum of their features and the products of these, in rows of one more than the features."""
    k = len(w)
    upper = np.triu_indices(k)
    lines = 1 + -(-len(upper[0]) // (k + 1))

    def measure(x: np.ndarray, y: np.ndarray) -> Sums:
        z = _standard(x, mean, scale)
        group = (np.floor(z @ w / width).astype(np.int64) + _MIDDLE) * 2 + y
        order = np.argsort(group, kind="stable")
        z, group = z[order], group[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        values = np.zeros((len(first), lines * (k + 1)))
        for row, part in zip(values, np.split(z, first[1:]), strict=True):
            row[0] = len(part)
            row[1 : k + 1] = part.sum(0)
            row[k + 1 : k + 1 + len(upper[0])] = (part.T @ part)[upper]
        return (group[first, None] * lines + np.arange(lines)).ravel(), values.reshape(-1, k + 1)

    return measure


def _all_pairs(sums: Sums, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss of "the good one wins" over all pairs, its gradient and its second derivatives, from the sums of ``_by_bin``.

    In a bin loss and gradient are followed to the second and first power of a strength's distance from the bin's mean.
    """
    k = len(w)
    upper = np.triu_indices(k)
    lines = 1 + -(-len(upper[0]) // (k + 1))
    group, values = sums[0][::lines] // lines, sums[1].reshape(-1, lines * (k + 1))
    sides = []
    for side in (1, 0):
        v = values[group % 2 == side]
        n, z, products = v[:, 0], v[:, 1 : k + 1], np.zeros((len(v), k, k))
        products[:, upper[0], upper[1]] = products[:, upper[1], upper[0]] = v[:, k + 1 : k + 1 + len(upper[0])]
        s = z @ w / n
        sides.append((n, z, s, products, products @ w - s[:, None] * z))  # the last: features times distances from the mean strength
    (n, g, s, gg, gs), (m, b, t, bb, bs) = sides
    loss, second, won, lost, bent, turned = 0.0, np.zeros((k, k)), np.zeros(len(n)), np.zeros(len(m)), np.zeros(len(n)), np.zeros(len(m))
    for at in range(0, len(n), 256):
        part = slice(at, at + 256)
        ahead = s[part, None] - t
        p = 1 / (1 + np.exp(np.clip(ahead, -50, 50)))
        v = p * (1 - p)
        loss += n[part] @ np.logaddexp(0, -ahead) @ m
        won[part], bent[part] = p @ m, v @ m
        lost += n[part] @ p
        turned += n[part] @ v
        cross = g[part].T @ v @ b
        second -= cross + cross.T
    pairs = n.sum() * m.sum()
    loss += (bent @ gs + turned @ bs) @ w / 2
    first = lost @ b + turned @ bs - won @ g + bent @ gs
    second += np.tensordot(bent, gg, 1) + np.tensordot(turned, bb, 1)
    return loss / pairs + DECAY / 2 * (w @ w), first / pairs + DECAY * w, second / pairs + DECAY * np.eye(k)


def _counts(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, width: float) -> Measure:
    def measure(x: np.ndarray, y: np.ndarray) -> Sums:
        group, n = np.unique((np.floor(_standard(x, mean, scale) @ w / width).astype(np.int64) + _MIDDLE) * 2 + y, return_counts=True)
        return group, n[:, None].astype(float)

    return measure


def _cut(sums: Sums, width: float) -> float:
    """The bin's lower end from which on documents are best called good; of several the middle one of the longest stretch."""
    at = sums[0] // 2 - _MIDDLE
    low = at.min()
    count = np.zeros((2, at.max() - low + 2))
    np.add.at(count, (sums[0] % 2, at - low), sums[1][:, 0])
    hits = np.r_[0, count[0].cumsum()[:-1]] + count[1][::-1].cumsum()[::-1]
    best = np.flatnonzero(hits == hits.max())
    stretch = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
    return float((low + stretch[len(stretch) // 2]) * width)


def _fit(total: Callable[[Measure, int], Sums], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """``fit`` for documents of ``k`` features, of which ``total`` adds up a measure with so many numbers to a key."""
    _, sums = total(_moments, k + 1)
    n, good = sums[:2, 0] if len(sums) else (0, 0)
    if not 0 < good < n:
        return np.zeros(k), np.ones(k), np.zeros(k), 0.0
    mean, square = (np.array([math.fsum(c) for c in part[:, 1:].T]) / n for part in np.split(sums, 2))
    scale = np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-9
    look = lambda w: _all_pairs(total(_by_bin(mean, scale, w, _width(w, WIDTH, BINS)), k + 1), w)
    w, size = np.zeros(k), 1.0
    loss, first, second = look(w)
    for _ in range(PASSES):  # Newton's steps, halved while the loss grows
        tried = np.rint((w - size * np.linalg.solve(second, first)) / WEIGHT_STEP) * WEIGHT_STEP
        if np.abs(tried - w).max() < NEAR:
            w = tried if size == 1 else w
            break
        found = look(tried)
        if found[0] <= loss:
            w, size, (loss, first, second) = tried, 1.0, found
        else:
            size /= 2
    width = _width(w, 0.0, EDGES)
    return mean, scale, w, _cut(total(_counts(mean, scale, w, width), 1), width)


def fit(good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean and scale of the features, weights and threshold, from the features of preferred and other documents.

    With either side empty there is nothing to prefer: weights are zero and
    every score is a half.
    """
    x, y = np.vstack([good, bad]), np.r_[np.ones(len(good), np.int64), np.zeros(len(bad), np.int64)]
    return _fit(lambda measure, _: measure(x, y), x.shape[1])


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def _measured(whole: DataFrame) -> DataFrame:
    return map_rows(whole, ["doc_id", "text"], lambda i, t: ((a, features(b)) for a, b in zip(i, t, strict=True)), "doc_id long, x array<double>")


def _matrix(column: pa.ListArray, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def learn(measured: DataFrame, labels: DataFrame) -> tuple:
    """What ``fit`` learns from all labelled rows of ``measured`` (``doc_id``, ``x``: features) that are not held out.

    Each pass adds up its measure in the tasks and by key; what reaches the
    driver is bounded by the numbers of bins.
    """
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("doc_id is not null and quality is not null")
    told = told.filter(~_held_out()).groupBy("doc_id").agg((F.max("quality") > 0).cast("long").alias("y"))
    one = measured.filter("doc_id is not null").filter(~_held_out()).groupBy("doc_id").agg(F.min("x").alias("x"))
    rows = materialise(one.join(told, "doc_id").select("x", "y"), "labelled")
    k = len(features(""))

    def total(measure: Measure, columns: int) -> Sums:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(0, np.int64), np.zeros((0, columns))
            for batch in batches:
                if batch.num_rows:
                    found = measure(_matrix(batch.column(0), k), batch.column(1).to_numpy())
                    held = _add_up(np.r_[held[0], found[0]], np.vstack([held[1], found[1]]))
            if len(held[0]):
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(held[0]) + 1) * columns, pa.int32()), pa.array(held[1].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(held[0]), values], names=["key", "v"])

        parts = rows.mapInArrow(run, "key long, v array<double>")
        found = parts.groupBy("key").agg(*[F.expr(f"sum(v[{i}])") for i in range(columns)]).toArrow()  # a row for each class and bin, or a dozen
        keys = found.column(0).to_numpy()
        order = np.argsort(keys)
        return keys[order], np.column_stack([c.to_numpy() for c in found.columns[1:]])[order]

    learned = _fit(total, k)
    discard(rows)
    return learned


def score(x: np.ndarray, learned: tuple) -> np.ndarray:
    mean, scale, w, cut = learned
    return 1 / (1 + np.exp(-np.clip(_standard(x, mean, scale) @ w - cut, -30, 30)))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text; one row per row of ``docs``.

    Labels of rows whose crc32(id as text) mod 3 is 1 are held out; all others
    are fitted on, whatever their number.  An id with several labels counts as
    good if one of them is, one with several texts is fitted on with one of
    them (the least by features); null labels and labels of absent ids are left
    out.  Without labels of both classes every score is a half.  Null and empty
    texts are scored like any other, texts of any length whole; a null id is
    never held out.  A score of exactly a half is predicted good.  Repeated rows
    each give a row; an empty table gives none.  Other columns are not read,
    whatever their names.  The features are written once, for fit and scores.
    """
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    measured = materialise(_measured(whole), "features")
    learned = learn(measured, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score(_matrix(batch.column(1), len(learned[2])), learned)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    scored = measured.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` predicts to be good, judged in place without a join.

    Texts that can be fitted on are measured twice, as none are written.
    """
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    learned = learn(_measured(whole.filter("doc_id is not null").filter(~_held_out())), labels)
    reach_workers(docs.sparkSession)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(score(np.array([features(t) for t in texts]).reshape(-1, len(learned[2])), learned) >= 0.5)

    return docs.filter(good(text_col))
