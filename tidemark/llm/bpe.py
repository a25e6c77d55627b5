"""Byte-level BPE encoding and decoding.

Encoding works on a doubly linked list of symbols with a priority queue of
merge ranks; entries that no longer describe the list are skipped when they
come up.  Decoding concatenates the vocabulary's byte strings.  Texts are cut
into chunks at spaces, where no pre-token can cross, and each worker keeps the
ids of chunks it has seen in a bounded cache.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cache, map_rows

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_MARK = "￿"
_SPACES_MEET = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: bytes that print stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def chunks(text: str) -> list[str]:
    """Cut before every space that follows a non-space: pre-tokens never cross such a place."""
    if _MARK in text:
        return re.split(r"(?<=\S)(?= )", text)
    if _SPACES_MEET.search(text):
        return _CUT.sub(_MARK + " ", text).split(_MARK)
    return text.replace(" ", _MARK + " ").split(_MARK)


class ByteBPE:
    """The vocabulary, merges and special strings of one tokenizer file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.byte_ids = {b: vocab[c] for c, b in letters.items()}
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.strings = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            if token not in self.special:
                self.strings[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.pieces = Cache(self._piece)

    def merge(self, ids: list[int]) -> list[int]:
        """Merge the symbols of one pre-token, lowest rank first, leftmost first among equals.

        The queue holds rank and place in one number.  ``rank[i]`` is the rank
        of the pair that starts at i now (-1: none); a queue entry with another
        rank is stale and skipped.
        """
        n, rank_of, made = len(ids), self.ranks.get, self.made
        rank = [rank_of(a << 32 | b, -1) for a, b in zip(ids, ids[1:])]  # noqa: B905  the last symbol has no neighbour
        queue = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        if not queue:
            return ids
        heapq.heapify(queue)
        rank.append(-1)
        before, after, pop, push = list(range(-1, n - 1)), list(range(1, n + 1)), heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            i, r = entry & 0xFFFFFFFF, entry >> 32
            if rank[i] != r:
                continue
            j = after[i]
            k = after[i] = after[j]
            new = ids[i] = made[r]
            ids[j] = rank[j] = rank[i] = -1
            if k < n:
                before[k] = i
                r = rank[i] = rank_of(new << 32 | ids[k], -1)
                if r >= 0:
                    push(queue, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = rank[h] = rank_of(ids[h] << 32 | new, -1)
                if r >= 0:
                    push(queue, r << 32 | h)
        return [i for i in ids if i >= 0]

    def cut(self, piece: str) -> list[str]:
        """The pre-tokens of a chunk; letters after at most one space are one."""
        return [piece] if piece.isalpha() or piece[:1] == " " and piece[1:].isalpha() else self.pre_tokens(piece)

    def _piece(self, piece: str) -> bytes:
        words = self.cut(piece)
        if len(words) == 1:
            byte_ids = self.byte_ids
            return np.array(self.merge([byte_ids[b] for b in piece.encode()]), "<u4").tobytes()
        pieces = self.pieces
        return b"".join([pieces[w] for w in words])

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        pieces = self.pieces
        if self.special_cut is None or not any(t in text for t in self.special):
            return b"".join([pieces[c] for c in chunks(text)]) if text else b""
        out = []
        for part in self.special_cut.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out += [pieces[c] for c in chunks(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@cache
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


def bpe_round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids of every text and of the text decoded from them.

    ``vocabulary`` is the path of a byte-level BPE tokenizer file that every
    executor can read.  Null texts count as empty; the digests are then those
    of no bytes.  Repeated rows give repeated results, texts of any length are
    encoded whole; rows with a null id keep it.  An empty table gives no rows;
    other columns are not read, whatever their names.  No shuffle.
    """

    def rows(bpe: ByteBPE, ids: list, texts: list) -> Iterator[tuple]:
        bpe.pieces.turn()
        for i, text in zip(ids, texts, strict=True):
            coded = bpe.encode(text or "")
            yield i, len(coded) // 4, hashlib.sha256(coded).hexdigest(), hashlib.sha256(bpe.decode(coded).encode()).hexdigest()

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], rows, SCHEMA, setup=lambda: load(vocabulary))


def encode_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids themselves: ``doc_id``, ``ids`` (array of int)."""

    def rows(bpe: ByteBPE, ids: list, texts: list) -> Iterator[tuple]:
        bpe.pieces.turn()
        for i, text in zip(ids, texts, strict=True):
            yield i, np.frombuffer(bpe.encode(text or ""), "<u4").astype(np.int32)

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], rows, "doc_id long, ids array<int>", setup=lambda: load(vocabulary))


def decode_ids(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """The inverse of ``encode_texts``: ``doc_id``, ``text``."""

    def rows(bpe: ByteBPE, ids: list, arrays: list) -> Iterator[tuple]:
        for i, a in zip(ids, arrays, strict=True):
            yield i, bpe.decode(np.array(a or [], "<u4").tobytes())

    return map_rows(tokens, ["doc_id", "ids"], rows, "doc_id long, text string", setup=lambda: load(vocabulary))
