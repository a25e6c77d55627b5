"""Windows of a frame stream in order, with the frames held until their window is whole."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import reach_workers
from .incremental import BUCKETS

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Cell:
    """What a bucket's state holds of one track: a list of rows or one value."""

    def __init__(self, rows: list[tuple] | None = None, value: tuple | None = None):
        self.rows, self.value = rows or [], value

    def put(self, rows: list[tuple]) -> None:
        self.rows = rows

    def clear(self) -> None:
        self.rows = []

    def update(self, value: tuple) -> None:
        self.value = value


class _Windows:
    """One track: the frames that pending windows need (a list), the start of the earliest of them and when they are overdue."""

    def __init__(self, width: int, stride: int, most_absent: int, unresolved: str):
        self.width, self.stride, self.most_absent, self.unresolved = width, stride, most_absent, unresolved
        self.frames, self.pending = _Cell(), _Cell(value=(0, 0))

    def _store(self, held: dict[int, tuple], start: int, due: int) -> None:
        kept = [(f, *x) for f, x in sorted(held.items()) if f >= start]  # earlier frames are in no pending window
        if kept:
            self.frames.put(kept)
        else:
            self.frames.clear()
        self.pending.update((start, due))

    def _whole(self, key: tuple, held: dict[int, tuple], start: int) -> tuple[list[tuple], int]:
        """Windows from ``start`` on that are whole, in order, up to the first that is not."""
        rows = []
        while all(f in held for f in range(start, start + self.width)):
            window = [held[f] for f in range(start, start + self.width)]
            absent = sum(not p for _, p in window)
            if absent <= self.most_absent:
                rows.append((key[0], start, [v for v, _ in window], absent))
            start += self.stride
        return rows, start

    def take(self, key: tuple, fresh: list[tuple], now: int) -> list[tuple]:
        """Windows that are whole with ``fresh`` frames (number, value, present, milliseconds)."""
        (start, due), held = self.pending.value, {f: (v, p) for f, v, p in self.frames.rows}
        for f, v, p, _ in fresh:
            if f >= start:
                held.setdefault(f, (v, p))
        found, start = self._whole(key, held, start)
        self._store(held, start, max(due, now + 1, max(at for *_, at in fresh) + 1) if any(f >= start for f in held) else 0)
        return found

    def expire(self, key: tuple) -> list[tuple]:
        """The watermark has passed all frames seen: windows that lack frames will not become whole."""
        (start, _), held = self.pending.value, {f: (v, p) for f, v, p in self.frames.rows}
        rows: list[tuple] = []
        while any(f >= start for f in held):
            have = sum(f in held for f in range(start, start + self.width))
            if self.unresolved == "raise":
                raise ValueError(f"window {start} of {key[0]} has {have} of {self.width} frames")
            start += self.stride
            found, start = self._whole(key, held, start)
            rows += found
        self._store(held, start, 0)
        return rows


class _Buckets(StatefulProcessor):
    """One bucket of tracks: what each of them holds, read and written together, and one timer, for what is overdue first."""

    def __init__(self, *how):
        self.how = how

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.frames = handle.getListState("frames", "track string, f bigint, value double, present boolean")
        self.pending = handle.getListState("pending", "track string, start bigint, due bigint")

    def _load(self) -> tuple[dict, int]:
        tracks: dict = defaultdict(lambda: _Windows(*self.how))
        for t, *value in self.pending.get():
            tracks[t].pending.update(tuple(value))
        for t, *frame in self.frames.get():
            tracks[t].frames.rows.append(tuple(frame))
        return tracks, self._first(tracks)

    @staticmethod
    def _first(tracks: dict) -> int:
        """When the first of the tracks is overdue; 0 if none waits."""
        return min((w.pending.value[1] for w in tracks.values() if w.pending.value[1]), default=0)

    def _save(self, tracks: dict) -> None:
        frames = [(t, *frame) for t, w in tracks.items() for frame in w.frames.rows]
        if frames:
            self.frames.put(frames)
        else:
            self.frames.clear()
        self.pending.put([(t, *w.pending.value) for t, w in tracks.items()])

    def _out(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=["track", "window_id", "states", "absent"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tracks, timer = self._load()
        fresh: dict = defaultdict(list)
        for part in rows:
            for t, f, v, p, at in zip(*(part[c].tolist() for c in ("track", "f", "value", "present", "at")), strict=True):
                fresh[t].append((int(f), None if pd.isna(v) else v, bool(p), at))
        now = timerValues.getCurrentWatermarkInMs()
        found = [row for t, frames in fresh.items() for row in tracks[t].take((t,), frames, now)]
        first = self._first(tracks)
        if timer and timer != first:
            self.handle.deleteTimer(timer)
        if first and first != timer:
            self.handle.registerTimer(first)
        self._save(tracks)
        yield from self._out(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tracks, _ = self._load()
        now = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        found = [row for t, w in tracks.items() if 0 < w.pending.value[1] <= now for row in w.expire((t,))]
        if first := self._first(tracks):
            self.handle.registerTimer(first)
        self._save(tracks)
        yield from self._out(found)

    def close(self) -> None:
        pass


def ordered_windows(frames: DataFrame, width: int = 8, stride: int | None = None, most_absent: int = 3, lateness: str = "1 minute", unresolved: str = "drop", buckets: int = BUCKETS) -> DataFrame:
    """``track``, ``window_id``, ``states`` (values in frame order) and ``absent`` of windows of ``width`` frames, every ``stride``.

    ``frames`` is a stream of ``track``, ``f``, ``value``, ``present``,
    ``seen_at``, in any order.  A window is given out once it and all before it
    are whole, whatever batch its frames came in; then frames that no pending
    window needs go.  Windows with more than ``most_absent`` absent frames are
    cut.  Once the watermark is past all frames seen of a track, windows that
    lack frames are dropped, or an error with ``unresolved="raise"``.  Of
    repeated frames the first counts.  State is kept by hash bucket of track,
    as each access to it is a message between Python and Spark.
    """
    spark = frames.sparkSession
    reach_workers(spark)
    spark.conf.set(STORE, ROCKS)  # such state is kept in RocksDB
    track = F.col("track").cast("string")  # pandas keeps strings as they are where some are null
    keyed = frames.withWatermark("seen_at", lateness).select(track.alias("track"), F.col("f").cast("bigint").alias("f"), F.col("value").cast("double").alias("value"), "present", "seen_at", F.coalesce(F.unix_millis("seen_at"), F.lit(0)).alias("at"))
    grouped = keyed.withColumn("bucket", F.pmod(F.xxhash64("track"), F.lit(buckets))).groupBy("bucket")
    processor = _Buckets(width, stride or width, most_absent, unresolved)
    w = grouped.transformWithStateInPandas(statefulProcessor=processor, outputStructType="track string, window_id bigint, states array<double>, absent bigint", outputMode="Append", timeMode="EventTime")
    return w.withColumn("track", F.col("track").cast(frames.schema["track"].dataType))
