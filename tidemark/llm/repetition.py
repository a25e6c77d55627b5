"""Quality rules by repetition coverage.

Words become numbers, a rolling polynomial hash over those numbers is grown
one word at a time through several n-gram lengths, and each length measures
the share of a text's word characters that lie inside n-grams found twice or
more.  Repeated lines are measured the same way.  No shuffle: every text is
judged on its own, in place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import WORD_SPACES, map_rows

#: Fixed values of the base rule.
BASE_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"

#: Largest share of word characters inside repeated n-grams, by n-gram length; a text above any of them is rejected.
MAX_NGRAM_SHARE = {4: 0.50, 5: 0.45, 6: 0.40, 8: 0.35, 10: 0.30}
#: Largest share of word characters inside lines equal to an earlier line.
MAX_LINE_SHARE = 0.30

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ngram_share double, line_share double"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LINE_SPACES = WORD_SPACES.decode()


def _mixed(ids: np.ndarray) -> np.ndarray:
    """SplitMix64 of small numbers, so that a polynomial over them has no structure to exploit."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x1234567)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeated(hashes: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Which n-grams occur twice or more; equal hashes are confirmed on the words themselves."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    out = np.zeros(len(hashes), bool)
    if not same.any():
        return out
    a, b = order[:-1][same], order[1:][same]
    if all((ids[a + j] == ids[b + j]).all() for j in range(n)):
        out[a] = out[b] = True
        return out
    _, inverse, counts = np.unique(np.lib.stride_tricks.sliding_window_view(ids, n), axis=0, return_inverse=True, return_counts=True)
    return counts[inverse.ravel()] > 1


def covered_words(ids: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each n-gram length, the mask of words inside an n-gram that occurs twice or more."""
    mixed, out, top = _mixed(ids), {}, len(ids)
    hashes, power = mixed.copy(), np.uint64(1)
    with np.errstate(over="ignore"):
        for n in range(2, max(lengths) + 1):
            if n > top:
                break
            power = power * _BASE
            hashes = hashes[: top - n + 1] + mixed[n - 1 :] * power
            if n in lengths:
                at = np.flatnonzero(_repeated(hashes, ids, n))
                step = np.zeros(top + 1, np.int32)
                step[at] += 1  # the positions differ, so plain indexing counts each
                step[at + n] -= 1
                out[n] = np.cumsum(step[:-1]) > 0
    return {n: out.get(n, np.zeros(top, bool)) for n in lengths}


def measure(text: str | None) -> tuple:
    """All measures of one text, in the order of SCHEMA without doc_id."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, WORD_SPACES)))
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    n_dup_lines = dup_line_chars = 0
    if "\n" in text:
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += len(line) - sum(line.count(c) for c in _LINE_SPACES)
            elif line.strip(_LINE_SPACES):
                seen.add(line)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    share, n_repeat, too_much = 0.0, 0, False
    if len(known) < n:
        sizes = np.fromiter((len(w.decode()) for w in known), np.int64, len(known))[ids]
        masks = covered_words(ids, sorted({*MAX_NGRAM_SHARE, BASE_WINDOW}))
        n_repeat = int(masks[BASE_WINDOW].sum())
        for length, most in MAX_NGRAM_SHARE.items():
            now = float(sizes[masks[length]].sum()) / word_chars
            share, too_much = max(share, now), too_much or now > most
    line_share = dup_line_chars / word_chars if word_chars else 0.0
    base_failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n
    kept = not base_failed and not too_much and line_share <= MAX_LINE_SHARE
    return n, word_chars, n_symbols, n_dup_lines, n_repeat, base_failed, kept, share, line_share


def repetition_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measures and the verdict per document.

    Null and empty texts have no words: all counts are 0, ``base_failed`` is
    true and ``kept`` false.  Repeated rows are judged alike, one row each.  A
    null id stays null.  Texts of any length are measured whole; an empty table
    gives no rows.  Other columns of ``docs`` are not read.
    """

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for i, t in zip(ids, texts, strict=True):
            yield (i, *measure(t))

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], rows, SCHEMA)


def keep_varied(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``repetition_quality`` keeps, all columns with them, judged in place without a join."""
    reach_workers(docs.sparkSession)

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(t)[6] for t in texts], dtype=bool)

    return docs.filter(kept(text_col))
