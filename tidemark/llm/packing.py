"""Best-fit packing planned on the histogram of lengths.

Best-fit decreasing runs over (length, count) pairs, so its cost depends on
the number of distinct lengths and not on the number of documents.  It gives
slots: "ranks r0 .. r0+n of length L go, t to a sequence, to the sequences
from ``base`` on, starting at ``offset``".  Pieces then get a rank within
their length and look their slot up.
"""

from __future__ import annotations

import os
import string
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import LONGEST_KEPT, Cache, materialise

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SCHEMA = PIECES + ", sequence_id long, offset long"

#: Rows of one length that are ranked by one task at most; longer lists are dealt over numbered parts.
RANKED_TOGETHER = 50_000

#: White space for str.split() that the tokenizer takes for symbols.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: Words, and words without their end symbols, whose ids a worker keeps, in each of two generations.
WORDS_KEPT, STEMS_KEPT = 400_000, 200_000
#: Words whose ids are gathered at once.
WORDS_AT_ONCE = 1 << 14
#: Bytes of the texts whose distinct words are looked up together; a longer text is a slice of its own.
BYTES_AT_ONCE = 1 << 21
#: First character after the Latin letters.
LATIN_END = "\u0250"


class WordIds:
    """Ids of a lower-casing word tokenizer that drops white space: no token crosses white space, so ids are kept by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: Whether a token ends a word, by id.
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words, self.stems = Cache(limit=WORDS_KEPT), Cache(limit=STEMS_KEPT)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers.

        Each distinct word of the slice is looked up once; what the words of
        the texts have is gathered from there.
        """
        self.words.turn()
        self.stems.turn()
        plain = [not any(c in t for c in _NOT_SPACE) for t in texts]
        split = pc.utf8_split_whitespace(pa.array([t if p else "" for t, p in zip(texts, plain, strict=True)], pa.large_string()))
        coded = split.flatten().dictionary_encode()
        ids = self._word_ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, every = sizes.cumsum() - sizes, np.frombuffer(b"".join(ids), "<u4")
        word = coded.indices.to_numpy()
        ends = np.concatenate([[0], sizes[word].cumsum()])
        out = np.empty(ends[-1], "<u4")
        for at in range(0, len(word), WORDS_AT_ONCE):
            own = word[at : at + WORDS_AT_ONCE]
            first, last = ends[at], ends[at + len(own)]
            out[first:last] = every[np.repeat(starts[own] - ends[at : at + len(own)], sizes[own]) + np.arange(first, last)]
        cuts = ends[split.offsets.to_numpy()]
        return [out[i:j].tobytes() if p else self._odd(t) for i, j, t, p in zip(cuts[:-1], cuts[1:], texts, plain, strict=True)]

    def _odd(self, text: str) -> bytes:
        """The ids of a text with what Python takes for white space and the tokenizer for symbols."""
        words = [w.decode() for w in text.encode().split()]
        distinct = list(dict.fromkeys(words))
        ids = dict(zip(distinct, self._word_ids(distinct), strict=True))
        return b"".join([ids[w] for w in words])

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        known, old = self.words, self.words.old
        found = list(map(known.get, words))
        new = []
        for k in [k for k, ids in enumerate(found) if ids is None]:
            w = words[k]
            ids = found[k] = old.get(w)
            if ids is None:
                new.append((k, w, *_stem(w)))
            else:
                known[w] = ids
        stems = self._stem_ids({x for _, _, *pair in new for x in pair})
        for k, w, stem, end in new:
            ids = found[k] = stems[stem] + stems[end]
            if len(w) <= LONGEST_KEPT:
                known[w] = ids
        return found

    def _stem_ids(self, stems: set[str]) -> dict[str, bytes]:
        known, old, out = self.stems, self.stems.old, {"": b""}
        letters, others = [], []
        for x in stems - out.keys():
            ids = known.get(x)
            if ids is None:
                ids = old.get(x)
                if ids is None:
                    (letters if x.isalpha() and _composed(x) else others).append(x)
                    continue
                known[x] = ids
            out[x] = ids
        for at in range(0, len(letters), 8192):
            part = letters[at : at + 8192]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            coded, ends = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(part):  # a vocabulary without tokens that end words
                others += part
                continue
            out.update((x, coded[i:j]) for x, i, j in zip(part, [0, *ends[:-1]], ends, strict=True))
        for at in range(0, len(others), 4096):
            part = others[at : at + 4096]
            for x, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                out[x] = np.array(e.ids, "<u4").tobytes()
        known.update((x, out[x]) for x in {*letters, *others} if len(x) <= LONGEST_KEPT)
        return out


def _composed(text: str) -> bool:
    """Whether composition and lower case change no character: so it is with small Latin letters."""
    return text.isascii() or max(text) < LATIN_END


def _stem(word: str) -> tuple[str, str]:
    """A word without the ASCII symbols at its end, in lower case, and these symbols.

    The tokenizer composes (NFC), lower-cases and parts letters and digits from
    symbols, so the two have the word's ids if what comes before the symbols
    ends, composed and in lower case, with a letter or digit.  That is looked
    at for words of Latin letters; others stay whole, for some letters fall
    apart in NFC and end with a mark, which symbols join.  So do words that may
    hold a special string, which has no other spelling.
    """
    stem = word.rstrip(string.punctuation)
    small = stem.lower()
    return (small, word[len(stem) :]) if small and small[-1].isalnum() and _composed(small) and _composed(stem) and "<|" not in word else (word, "")


@cache
def load(path: str) -> WordIds:
    return WordIds(path)


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, end every document with id 0 and cut what is longer than ``capacity``."""

    reach_workers(docs.sparkSession)
    names = [p.split()[0] for p in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(vocabulary)
        for batch in batches:
            ids, sizes = batch.column(0).to_pylist(), pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            slices = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // BYTES_AT_ONCE, prepend=0)).tolist()
            for first, last in pairwise([0, *(k for k in slices if k), len(ids)]):
                texts = [t or "" for t in batch.column(1).slice(first, last - first).to_pylist()]
                rows = []
                for i, coded in zip(ids[first:last], words.encode(texts), strict=True):
                    coded += b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                        part = coded[at : at + 4 * capacity]
                        rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def plan_slots(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over counts; rows (length, r0, count, base, per_sequence, offset), sorted by length and r0.

    A length opens at most two groups of sequences and a step that takes only
    part of a group splits it once, so there are at most three groups per
    length, and a group takes at most about sqrt(2 * capacity) different
    lengths: the plan's size has a bound set by ``capacity`` alone.
    """
    groups: dict[int, list[tuple[int, int]]] = {}
    open_sizes: list[int] = []
    slots: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def put(residual: int, base: int, many: int) -> None:
        if many and residual:
            if residual not in groups:
                groups[residual] = []
                insort(open_sizes, residual)
            groups[residual].append((base, many))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(open_sizes, length)
            if at < len(open_sizes):
                residual = open_sizes[at]
                base, many = groups[residual].pop()
                if not groups[residual]:
                    del groups[residual], open_sizes[at]
            else:
                residual, base = capacity, sequences
                many = max(1, left // (capacity // length))
                sequences += many
            each = residual // length
            full = min(many, left // each)
            used, each = (full, each) if full else (1, left)
            slots.append((length, rank, used * each, base, each, capacity - residual))
            put(residual, base + used, many - used)
            put(residual - each * length, base, used)
            left, rank = left - used * each, rank + used * each
    return np.array(sorted(slots), np.int64).reshape(-1, 6)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give every piece its sequence and offset; ``pieces`` has ``length`` and is read more than once, so it should be a written table."""
    spark = pieces.sparkSession
    reach_workers(spark)
    histogram = {int(r.length): int(r.n) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    slots = spark.sparkContext.broadcast(plan_slots(histogram, capacity))
    parts = spark.createDataFrame([(k, -(-n // RANKED_TOGETHER)) for k, n in histogram.items()], "length long, parts long")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("parts")))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start")
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["length", "part"])
    names = [p.split()[0] for p in PIECES.split(", ")]
    ranked = ranked.select(*names, (F.col("rank") + F.col("skip")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = slots.value
        keys = plan[:, 0] << 44 | plan[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = plan[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            q = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(row[:, 3] + q // row[:, 4]), pa.array(row[:, 5] + q % row[:, 4] * length)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, SCHEMA)


def best_fit_pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Null and empty texts are one piece holding id 0 alone.  Texts of any length
    count whole; only those of more than ``capacity`` tokens are cut.  Repeated
    rows are packed each by itself, rows with a null id too; ties in length are
    dealt by id, piece and start.  An empty table gives no rows; other columns
    are not read, whatever their names.  Only the small pieces table is
    shuffled; texts and ids never are.
    """
    return pack_pieces(materialise(cut_pieces(docs, vocabulary, capacity, id_col, text_col), "pieces"), capacity)
