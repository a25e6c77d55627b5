"""Substring dedup by relative Lempel-Ziv parsing.

A document is parsed against the documents with smaller ids: a factor says
"these words stand in that document from that place on".  Reference text is
indexed in blocks keyed by anchors.  A window's anchor is the smallest hash of
the 8-word runs inside it, so equal windows have equal anchors and a window
need only be sought in its anchor's block.

1. Anchors are counted; those of a single document are dropped.
2. Documents that hold shared anchors send the words of each anchor's stretch
   of windows to the anchor's block.
3. A block parses its stretches in order of ids, greedily from left to right:
   where the words of a window stand in the reference, the factor grows word
   by word as far as the reference agrees.  Equal hashes only propose a place;
   the words decide.  Behind a factor's end the windows that cross the boundary
   are looked up anew, so none is missed.
4. A document's factors from all its blocks that continue each other (same
   reference document, same distance) are joined: maximal factors.  All are at
   least one window long, and the words they cover are removed.

A block parses HOT_ROWS stretches at most.  The block of an anchor with more is
cut further, by the whole window, to blocks whose windows are all equal (anchor
and window hash agree, 128 bits together).  There the parse of step 3 is known
beforehand, one factor into the smallest id, so an aggregate that combines
before the shuffle gives it; step 4 makes long factors of these too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import join_counted, map_arrays, map_rows, materialise
from .rolling import roll, sliding_min, word_hashes

WINDOW = 50
ANCHOR_WORDS = 8
#: Stretches that one block parses in a stream at most.
HOT_ROWS = 5_000

FACTORS = "doc_id long, row_key long, start long, length long, ref_doc long, ref_start long"


def stretches(hashes: np.ndarray, window: int, anchor_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and end of every stretch of windows with one anchor, from the hashes of a text's words."""
    if len(hashes) < window:
        return (np.zeros(0, np.int64),) * 3
    low = sliding_min(roll(hashes, anchor_words), window - anchor_words + 1)
    first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    return low[first].astype(np.int64), first, np.r_[first[1:], len(low)]


def _row_key(text: Column) -> Column:
    return F.xxhash64(text)


class Block:
    """The reference of one anchor: the windows of earlier documents, and where each stands first."""

    def __init__(self, window: int):
        self.window = window
        self.index: dict[int, list[tuple]] = {}  # window hash: (words, place in them, document, place of the words in it) of each window with it
        self.present: int | None = None
        self.waiting: list[tuple] = []  # windows of the present document

    def parse(self, doc: int, first: int, words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """Factors (start, length, ref_doc, ref_start) of the next stretch, whose words stand in ``doc`` from ``first`` on."""
        if doc != self.present:
            for key, entry in self.waiting:
                self.index.setdefault(key, []).append(entry)
            self.present, self.waiting = doc, []
        window, out, at = self.window, [], 0
        hashes = roll(word_hashes(words), window).tolist()
        while at < len(hashes):
            for other, place, ref, ref_first in self.index.get(hashes[at], ()):
                if words[at : at + window] == other[place : place + window]:
                    length = window
                    most = min(len(words) - at, len(other) - place)
                    while length < most and words[at + length] == other[place + length]:
                        length += 1
                    out.append((first + at, length, ref, ref_first + place))
                    at += length - window + 1  # the next window crosses the factor's end
                    break
            else:
                self.waiting.append((hashes[at], (words, at, doc, first)))
                at += 1
        return out


def duplicate_factors(docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Factors of every document in documents with smaller ids: FACTORS rows, dealt by document.  ``docs`` has ``doc_id``, ``row_key`` and ``text``."""

    def anchors(ids: list, keys: list, texts: list) -> Iterator[tuple]:
        made = [(i, k, *stretches(word_hashes(t.encode().split()), window, anchor_words)[:2]) for i, k, t in zip(ids, keys, texts, strict=True)]
        sizes = [len(x[2]) for x in made]
        if sum(sizes):
            yield np.concatenate([x[2] for x in made]), np.repeat(np.array(ids), sizes), np.repeat(np.array(keys), sizes), np.concatenate([x[3] for x in made])

    named = docs.filter("doc_id is not null and text is not null")
    seen = materialise(map_arrays(named, ["doc_id", "row_key", "text"], anchors, "anchor long, doc_id long, row_key long, first long"), "seen")
    total = seen.count()
    shared = seen.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    shared = materialise(shared.filter("low < high").select("anchor", "n", (F.col("n") > hot_rows).alias("hot")), "anchors")
    # first * 2 + hot of each document's shared stretches
    kept = join_counted(seen, shared, ["anchor"], total).groupBy("doc_id", "row_key").agg(F.collect_list(F.col("first") * 2 + F.col("hot").cast("long")).alias("firsts"))
    kept = kept.withColumnRenamed("doc_id", "d").withColumnRenamed("row_key", "k")

    def send(ids: list, keys: list, texts: list, firsts: list) -> Iterator[tuple]:
        anchor, docs_, rows, start, hots, body = [], [], [], [], [], []
        for i, k, text, wanted in zip(ids, keys, texts, firsts, strict=True):
            words = text.encode().split()
            hashes = word_hashes(words)
            found, first, end = stretches(hashes, window, anchor_words)
            wanted = np.unique(np.array(wanted, np.int64))
            at, hot = np.searchsorted(first, wanted >> 1), (wanted & 1).tolist()
            anchor.append(found[at])
            docs_.append(np.full(len(at), i))
            rows.append(np.full(len(at), k))
            start.append(first[at])
            hots += map(bool, hot)
            windows = roll(hashes, window) if any(hot) else None
            for h, a, b in zip(hot, first[at].tolist(), end[at].tolist(), strict=True):
                body.append(windows[a:b].tobytes() if h else b" ".join(words[a : b + window - 1]))
        if body:
            yield *map(np.concatenate, (anchor, docs_, rows, start)), hots, body

    both = docs.join(kept, (docs.doc_id == kept.d) & (docs.row_key == kept.k), "inner").select("doc_id", "row_key", "text", "firsts")
    sent = map_arrays(both, ["doc_id", "row_key", "text", "firsts"], send, "anchor long, doc_id long, row_key long, first long, hot boolean, body binary")
    sent = materialise(sent, "stretches")

    out = pa.schema([pa.field(x.split()[0], pa.int64()) for x in FACTORS.split(", ")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, block = None, Block(window)
        for batch in batches:
            rows = []
            for anchor, doc, key, first, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != present:
                    present, block = anchor, Block(window)
                rows += [(doc, key, *f) for f in block.parse(doc, first, body.split(b" "))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=out)

    reach_workers(docs.sparkSession)
    blocks = sent.filter("not hot").select("anchor", "doc_id", "row_key", "first", "body").repartition(F.col("anchor")).sortWithinPartitions("anchor", "doc_id", "first")
    factors = blocks.mapInArrow(parse, FACTORS)

    def spread(anchor: list, ids: list, keys: list, firsts: list, raws: list) -> Iterator[tuple]:
        sizes = [len(r) // 8 for r in raws]
        starts = np.concatenate([np.arange(f, f + n) for f, n in zip(firsts, sizes, strict=True)])
        yield *(np.repeat(np.array(c), sizes) for c in (anchor, ids, keys)), np.frombuffer(b"".join(raws), np.int64), starts

    hot = sent.filter("hot")
    if not hot.isEmpty():
        single = map_arrays(hot, ["anchor", "doc_id", "row_key", "first", "body"], spread, "anchor long, doc_id long, row_key long, window long, start long")
        place = F.min(F.struct("doc_id", "start")).alias("ref")
        mins = single.groupBy("anchor", "window").agg(place, F.max("doc_id").alias("high"), F.count("*").alias("n"))
        mins = materialise(mins.filter("ref.doc_id < high").select("anchor", "window", "ref", "n"), "windows")
        found = join_counted(single, mins, ["anchor", "window"], total).filter("ref.doc_id < doc_id")
        factors = factors.unionByName(found.select("doc_id", "row_key", "start", F.lit(window).cast("long").alias("length"), F.col("ref.doc_id").alias("ref_doc"), F.col("ref.start").alias("ref_start")))
    return joined_factors(factors)


def joined_factors(factors: DataFrame) -> DataFrame:
    """Factors of a document that continue each other (same reference document and distance, meeting or overlapping), each run as one; repeats are one."""
    dealt = factors.repartition(F.col("doc_id"), F.col("row_key"))  # serves the windows and aggregates by document after it, too
    line = [F.col("doc_id"), F.col("row_key"), F.col("ref_doc"), F.col("start") - F.col("ref_start")]
    w = Window.partitionBy(*line).orderBy("start", "length")
    end = F.col("start") + F.col("length")
    opens = F.col("start") > F.coalesce(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    runs = dealt.withColumn("opens", opens.cast("long")).withColumn("run", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = runs.groupBy("doc_id", "row_key", "ref_doc", (F.col("start") - F.col("ref_start")).alias("distance"), "run").agg(F.min("start").alias("start"), F.max(end).alias("end"))
    return joined.select("doc_id", "row_key", "start", (F.col("end") - F.col("start")).alias("length"), "ref_doc", (F.col("start") - F.col("distance")).alias("ref_start"))


def _with_spans(docs: DataFrame, id_col: str, text_col: str, rest: Column, **how) -> DataFrame:
    """``doc_id``, ``text``, ``rest`` and ``spans``: the distinct [start, start + length) of a row's factors as start << 32 | end, or null."""
    text = docs[text_col]
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), _row_key(text).alias("row_key"), text.alias("text"), rest.alias("rest"))
    factors = duplicate_factors(base.select("doc_id", "row_key", "text"), **how)  # dealt by doc_id and row_key
    span = F.shiftleft("start", 32) + F.col("start") + F.col("length")
    spans = factors.groupBy(F.col("doc_id").alias("d"), F.col("row_key").alias("k")).agg(F.collect_set(span).alias("spans"))
    return base.join(spans, (base.doc_id == spans.d) & (base.row_key == spans.k), "left").select("doc_id", "text", "rest", "spans")


def kept_mask(n: int, spans: list[int] | None) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    if spans:
        s = np.array(spans, np.int64)
        np.add.at(step, s >> 32, 1)
        np.add.at(step, s & 0xFFFFFFFF, -1)
    return np.cumsum(step[:-1]) == 0


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of every document.

    Each word inside a 50-word window that also starts in a document with a
    smaller id is removed.  Null and empty texts and texts under 50 words lose
    nothing; rows with a null id neither lose words nor serve as reference.
    Repeated rows of one id do not count against each other and get equal
    results.  Of equal texts the one with the smallest id stays whole.  Texts
    of any length are parsed whole, by one task each; an empty table gives no
    rows.  Other columns are not read, whatever their names.
    """

    def rows(ids: list, texts: list, spans: list) -> Iterator[tuple]:
        for i, text, s in zip(ids, texts, spans, strict=True):
            words = (text or "").encode().split()
            if s is None:
                yield i, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()
                continue
            keep = kept_mask(len(words), s)
            left = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            yield i, len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()

    return map_rows(_with_spans(docs, id_col, text_col, F.lit(None), **how), ["doc_id", "text", "spans"], rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_duplicates(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the duplicate spans cut from ``text`` and ``n_chars`` counted again; texts that lose nothing stay as they are, others are their kept words joined by one space.

    All rows and columns stay, also rows with a null id or text and repeated
    rows; a text that loses all its words becomes empty.  See
    ``substring_dedup`` for ties, long texts and empty tables.
    """
    reach_workers(docs.sparkSession)
    joined = _with_spans(docs, "doc_id", "text", F.struct(*[docs[c] for c in docs.columns if c != "text"]), **how)

    @F.pandas_udf("string")
    def cut(text, spans):  # noqa: ANN001, ANN202
        import pandas as pd

        done = []
        for t, s in zip(text, spans, strict=True):
            if t is None or s is None:
                done.append(t)
                continue
            words = t.encode().split()
            done.append(b" ".join([w for w, k in zip(words, kept_mask(len(words), list(s)).tolist(), strict=True) if k]).decode())
        return pd.Series(done, dtype="object")

    text = F.when(F.col("spans").isNotNull(), cut("text", "spans")).otherwise(F.col("text"))
    out = joined.select(text.alias("text"), "rest")
    kept = {c: F.col("text") if c == "text" else F.col("rest").getField(c) for c in docs.columns}
    if "n_chars" in kept:
        kept["n_chars"] = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(kept["n_chars"])
    return out.select(*[v.alias(c) for c, v in kept.items()])
