"""Lookups on the frame grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_grid(frame: Column, width: int) -> Column:
    """The nearest multiple of ``width``, halves to even."""
    return (F.rint(frame / F.lit(float(width))) * width).cast("bigint")


def preferred_lookup(probe: DataFrame, build: DataFrame, keys: list[str], base: Column, offsets: list[int], build_frame: str, value: str, row_id: list[str]) -> DataFrame:
    """For every probe row the ``value`` at the first of ``base + offsets`` that ``build`` has, or null.

    The candidates make an equi join; the row keeps the hit with the smallest
    place in ``offsets``.
    """
    tries = F.array(*[F.struct(F.lit(i).alias("pref"), (base + o).alias(build_frame)) for i, o in enumerate(offsets)])
    spread = probe.withColumn("_c", F.explode(tries)).select("*", F.col("_c.pref").alias("pref"), F.col(f"_c.{build_frame}").alias(build_frame)).drop("_c")
    hits = spread.join(build, [*keys, build_frame]).groupBy(*row_id).agg(F.min_by(value, "pref").alias(value))
    return probe.join(hits, row_id, "left")


def index_map(i: Column, native: Column, resampled: Column) -> Column:
    """The native frame of resampled frame i: rint(linspace(0, native - 1, resampled))[i]; the last is pinned, one frame maps to 0."""
    step = (native - 1) / (resampled - 1).cast("double")
    return F.when(resampled <= 1, F.lit(0)).when(i == resampled - 1, native - 1).otherwise(F.rint(i * step)).cast("bigint")


def anchor_chunk(start: Column, fps: Column, width: int, chunks: Column) -> Column:
    """floor(start * fps / width), held inside [0, chunks - 1]."""
    return F.least(F.greatest(F.floor(start * fps / width), F.lit(0)), chunks - 1).cast("bigint")


def fan_out(tracks: DataFrame, track: str, native: str, resampled: str) -> DataFrame:
    """(track, native, resampled): for each native frame that is used the resampled frames it gives, in order."""
    i = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(resampled) - 1)).alias("_i")
    each = tracks.select(track, native, resampled, i).select(track, "_i", index_map(F.col("_i"), F.col(native), F.col(resampled)).alias("native"))
    return each.groupBy(track, "native").agg(F.array_sort(F.collect_list("_i")).alias("resampled"))
