"""Token counts by rank-synchronous array merging.

The pre-tokens that a batch of texts brings for the first time are held
together as one ragged numpy array of symbols.  In each round every sequence
looks up the merge ranks of its neighbours and applies its own lowest-ranked
pair everywhere at once; sequences without a mergeable pair leave.  The count
of a text is the sum of what survives in its pre-tokens.

A long unbroken pre-token goes through the same rounds alone.  It keeps the
places of its pairs by rank, so a round costs what it merges, not its length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteBPE, chunks
from .common import LONGEST_KEPT, Cache, map_rows

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

_NONE = np.int64(1) << 40
#: Bytes from which a pre-token is merged alone.
LONG = 256


class RankSync:
    def __init__(self, path: str):
        bpe = ByteBPE(path)
        keys = np.fromiter(bpe.ranks, np.int64, len(bpe.ranks))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(bpe.ranks.values(), np.int64, len(keys))[order]
        self.made = np.array(bpe.made, np.int64)
        self.byte_ids = np.array([bpe.byte_ids[b] for b in range(256)], np.int64)
        self.special, self.special_cut, self.cut = bpe.special, bpe.special_cut, bpe.cut
        self.pieces = Cache()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of symbols, _NONE if it has none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def survivors(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each pre-token ends with."""
        counts = np.zeros(len(words), np.int64)
        short = [i for i, w in enumerate(words) if len(w) < LONG]
        if short:
            counts[short] = self._together([words[i] for i in short])
        for i, w in enumerate(words):
            if len(w) >= LONG:
                counts[i] = self._alone(w)
        return counts

    def _alone(self, word: bytes) -> int:
        n = count = len(word)
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
        rank = np.append(self.rank(ids[:-1], ids[1:]), _NONE)
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(at: np.ndarray) -> None:
            at = at[rank[at] < _NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            found, first = np.unique(rank[at], return_index=True)
            for r, part in zip(found.tolist(), np.split(at, first[1:]), strict=bool(len(found))):
                if r not in places:
                    places[r] = []
                    heapq.heappush(queue, r)
                places[r].append(part)

        note(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            # of pairs that overlap, every other one from the left is taken
            index = np.arange(len(at))
            starts = np.r_[True, after[at[:-1]] != at[1:]]
            take = at[(index - np.maximum.accumulate(np.where(starts, index, 0))) % 2 == 0]
            right = after[take]
            behind = after[right]
            ids[take] = self.made[r]
            rank[right] = _NONE
            after[take] = behind
            inside = behind < n
            before[behind[inside]] = take[inside]
            count -= len(take)
            left = before[take]
            touched = np.unique(np.r_[take, left[left >= 0]])
            follow = after[touched]
            rank[touched] = _NONE
            paired = touched[follow < n]
            rank[paired] = self.rank(ids[paired], ids[follow[follow < n]])
            note(paired)
        return count

    def _together(self, words: list[bytes]) -> np.ndarray:
        sizes = np.array([len(w) for w in words], np.int64)
        counts = sizes.copy()
        flat = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(flat) > 1:
            rank = np.where(owner[:-1] == owner[1:], self.rank(flat[:-1], flat[1:]), _NONE)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, _NONE], first)
            alive = lowest < _NONE
            if not alive.any():
                break
            spread = np.repeat(lowest, np.diff(np.r_[first, len(flat)]))
            hit = (rank == spread[:-1]) & (rank < _NONE)
            # of pairs that overlap (a symbol with itself), every other one from the left is taken
            index = np.arange(len(hit))
            starts = hit & ~np.r_[False, hit[:-1]]
            run_start = np.maximum.accumulate(np.where(starts, index, 0))
            hit &= (index - run_start) % 2 == 0
            flat[:-1][hit] = self.made[rank[hit]]
            keep = np.repeat(alive, np.diff(np.r_[first, len(flat)]))
            np.subtract.at(counts, owner[:-1][hit], 1)
            keep[1:] &= ~hit
            flat, owner = flat[keep], owner[keep]
        return counts

    def learn(self, pieces: set[str]) -> dict[str, int]:
        """Put the counts of new chunks into the cache, all in one array pass; those too long to keep are returned."""
        known, old = self.pieces, self.pieces.old
        for p in pieces & old.keys():
            known[p] = old[p]
        cut = {p: self.cut(p) for p in pieces - old.keys()}
        new = list({w for ws in cut.values() for w in ws if w not in known})
        counts = dict(zip(new, self.survivors([w.encode() for w in new]).tolist(), strict=True)) if new else {}
        found = counts | {p: sum([counts[w] if w in counts else known[w] for w in ws]) for p, ws in cut.items() if len(ws) != 1}
        long = {p: n for p, n in found.items() if len(p) > LONGEST_KEPT}
        known.update((p, n) for p, n in found.items() if p not in long)
        return long

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of every text."""
        parts: list[list[str]] = []
        extra = [0] * len(texts)
        for k, text in enumerate(texts):
            if self.special_cut is None or not any(t in text for t in self.special):
                parts.append(chunks(text) if text else [])
                continue
            parts.append([])
            for part in self.special_cut.split(text):
                if part in self.special:
                    extra[k] += 1
                elif part:
                    parts[-1] += chunks(part)
        self.pieces.turn()
        long = self.learn(set().union(*parts).difference(self.pieces))
        known = self.pieces.__getitem__
        if long:
            known = lambda c: long[c] if c in long else self.pieces[c]
        return [n + sum(map(known, cs)) for n, cs in zip(extra, parts, strict=True)]


@cache
def load(path: str) -> RankSync:
    return RankSync(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether there are more tokens than ``limit``.

    Null texts count as empty (0 bytes, 0 tokens).  Repeated rows give
    repeated results, and rows with a null id keep it.  Texts of any length,
    also unbroken ones, count whole.  An empty table gives no rows.  No
    shuffle; other columns are not read, whatever their names.
    """

    def rows(counter: RankSync, ids: list, texts: list) -> Iterator[tuple]:
        texts = [t or "" for t in texts]
        for i, t, n in zip(ids, texts, counter.count(texts), strict=True):
            yield i, len(t.encode()), n, n > limit

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), ["doc_id", "text"], rows, SCHEMA, setup=lambda: load(vocabulary))
