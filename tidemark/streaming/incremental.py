"""Structured Streaming forms of the incremental paths."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


#: Hash buckets by which streams keep state: Python is called for a bucket, not for every key.  A stream keeps the number it began with.
BUCKETS = 4096


def windowed_counts(events: DataFrame, window: str = "1 day", lateness: str = "1 hour", time: str = "ts") -> DataFrame:
    """Counts per event-time window and type, for streams (with a watermark) and batches alike."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_t", lateness)
    w = timed.groupBy(F.window("_t", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def presence_windows(frames: DataFrame, width: int, most_absent: int = 3, lateness: str = "1 minute", unresolved: str = "drop", buckets: int = BUCKETS) -> DataFrame:
    """Windows of ``width`` frames with at most ``most_absent`` absent ones; ``frames`` has ``track``, ``f``, ``present``, ``seen_at``.

    On a stream a window is decided as soon as its last frame is in, whatever
    day it is, and its state goes.  A window that is still not whole when the
    watermark is ``lateness`` past its last frame seen is dropped like in a
    batch, or, with ``unresolved="raise"``, an error.  Rows of one frame count
    once each.  State is kept by hash bucket of track and window, the pending
    windows of one bucket together.
    """
    keyed = frames.withColumn("window_id", (F.floor(F.col("f") / width) * width).cast("bigint"))
    if not frames.isStreaming:
        w = keyed.groupBy("track", "window_id").agg(F.count("*").alias("frames"), F.count_if(~F.col("present")).alias("absent"))
        return w.filter((F.col("frames") == width) & (F.col("absent") <= most_absent)).select("track", "window_id", "absent")

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        pending = {(t, w): (seen, absent, due) for t, w, seen, absent, due in zip(*state.get, strict=True)} if state.exists else {}
        fresh: dict[tuple, list[int]] = {}
        for b in () if state.hasTimedOut else batches:
            for t, w, present, at in zip(*(b[c].tolist() for c in ("track", "window_id", "present", "at")), strict=True):
                x = fresh.setdefault((t, w), [0, 0, 0])
                x[0], x[1], x[2] = x[0] + 1, x[1] + (not present), max(x[2], at)
        whole = []
        for window, (seen, absent, last) in fresh.items():
            old = pending.pop(window, (0, 0, 0))
            seen, absent = seen + old[0], absent + old[1]
            if seen < width:
                pending[window] = (seen, absent, max(old[2], last + 1, now + 1))
            elif seen == width and absent <= most_absent:
                whole.append((*window, absent))
        for window, (seen, _, due) in list(pending.items()):
            if due < now:  # the watermark has passed all its frames, and none came
                if unresolved == "raise":
                    raise ValueError(f"window {window[1]} of {window[0]} has {seen} of {width} frames")
                del pending[window]
        if pending:
            state.update(tuple(map(list, zip(*((*window, *x) for window, x in pending.items()), strict=True))))
            state.setTimeoutTimestamp(min(due for _, _, due in pending.values()))
        elif state.exists:
            state.remove()
        if whole:
            yield pd.DataFrame(whole, columns=["track", "window_id", "absent"])

    # as strings, which pandas keeps as they are where some are null
    timed = keyed.withWatermark("seen_at", lateness).select(F.col("track").cast("string").alias("track"), F.col("window_id").cast("string").alias("window_id"), "present", "seen_at", F.coalesce(F.unix_millis("seen_at"), F.lit(0)).alias("at"))
    grouped = timed.withColumn("bucket", F.pmod(F.xxhash64("track", "window_id"), F.lit(buckets))).groupBy("bucket")
    held = "tracks array<string>, windows array<string>, seen array<bigint>, absent array<bigint>, due array<bigint>"
    w = grouped.applyInPandasWithState(decide, "track string, window_id string, absent bigint", held, "append", GroupStateTimeout.EventTimeTimeout)
    return w.select(F.col("track").cast(frames.schema["track"].dataType).alias("track"), F.col("window_id").cast("bigint").alias("window_id"), "absent")


def run_available(stream: DataFrame, target: str, checkpoint: str, step: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append") -> None:
    """Process all that is there and stop; a rerun with the same checkpoint takes only what is new.

    Each batch goes to its own folder under ``target``, so a batch that is run
    again after a failure overwrites its own output.
    """

    def write(batch: DataFrame, number: int) -> None:
        (step(batch) if step else batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def stream_parquet(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A folder of parquet files as a bounded-rate stream."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
