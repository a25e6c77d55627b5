"""Windows over frames of a track: rows with a track key and a frame number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frames(events: DataFrame, track: str = "user_id", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Number the rows of each track from 0 as ``f``."""
    return events.withColumn("f", (F.row_number().over(Window.partitionBy(track).orderBy(*order)) - 1).cast("bigint"))


def tumbling(fr: DataFrame, track: str, width: int, value: str) -> DataFrame:
    """Complete windows of ``width`` frames: ``window_id`` (first frame) and ``states`` in frame order."""
    w = fr.groupBy(track, (F.floor(F.col("f") / width) * width).alias("window_id")).agg(F.array_sort(F.collect_list(F.struct("f", value))).alias("s"))
    return w.filter(F.size("s") == width).select(track, "window_id", F.transform("s", lambda x: x[value]).alias("states"))


def sliding(fr: DataFrame, track: str, width: int, value: str) -> DataFrame:
    """Complete windows starting at every frame."""
    over = Window.partitionBy(track).orderBy("f").rowsBetween(0, width - 1)
    return fr.select(track, F.col("f").alias("window_id"), F.collect_list(value).over(over).alias("states")).filter(F.size("states") == width)


def centred_mean(fr: DataFrame, track: str, value: str) -> Column:
    """Mean over five frames; at the ends the first and last frame count as often as they are missing.  Nulls carry no weight."""
    w = Window.partitionBy(track).orderBy("f")
    last = F.max("f").over(Window.partitionBy(track))
    total, weight = F.lit(0.0), F.lit(0.0)
    ends = Window.partitionBy(track).orderBy("f").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_v, last_v = F.first(value).over(ends), F.last(value).over(ends)
    for o in range(-2, 3):
        x = F.col(value) if o == 0 else F.lag(value, -o).over(w)
        x = F.when(F.col("f") + o < 0, first_v).when(F.col("f") + o > last, last_v).otherwise(x)
        total, weight = total + F.coalesce(x, F.lit(0.0)), weight + x.isNotNull().cast("double")
    return F.when(F.col(value).isNotNull(), total / F.nullif(weight, F.lit(0.0)))


def fill_gaps(fr: DataFrame, track: str, value: str, most: int = 5) -> DataFrame:
    """``filled``: null runs of at most ``most`` frames interpolated; at the ends of a track the nearest value stands."""
    w = Window.partitionBy(track).orderBy("f")
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    seen = F.when(F.col(value).isNotNull(), F.struct(F.col("f").alias("f"), F.col(value).alias("v")))
    d = fr.withColumns({"_p": F.last(seen, ignorenulls=True).over(before), "_n": F.first(seen, ignorenulls=True).over(after), "_last": F.max("f").over(Window.partitionBy(track))})
    gap = F.coalesce(F.col("_n.f"), F.col("_last") + 1) - F.coalesce(F.col("_p.f"), F.lit(-1)) - 1
    line = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * ((F.col("f") - F.col("_p.f")) / (F.col("_n.f") - F.col("_p.f")))
    value_in = F.when(F.col("_p").isNull(), F.col("_n.v")).when(F.col("_n").isNull(), F.col("_p.v")).otherwise(line)
    return d.withColumn("filled", F.when(F.col(value).isNotNull(), F.col(value)).when(gap <= most, value_in)).drop("_p", "_n", "_last")


def forward_back_fill(partition: list[str], value: str) -> Column:
    w = Window.partitionBy(*partition).orderBy("f")
    return F.coalesce(F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))


def runs(fr: DataFrame, track: str, value: str) -> DataFrame:
    """Contiguous runs of equal values: ``run``, ``value``, ``start``, ``length``."""
    w = Window.partitionBy(track).orderBy("f")
    change = (F.lag(value).over(w).isNull() | (F.lag(value).over(w) != F.col(value))).cast("bigint")
    return fr.withColumn("_c", change).withColumn("run", F.sum("_c").over(w)).groupBy(track, "run", value).agg(F.min("f").alias("start"), F.count("*").alias("length"))


def debounced_flips(flags: Column, least_gap: Column | float, target: int = 4) -> Column:
    """Times kept from an array of (t, flag) in order: flips at least ``least_gap`` after the last kept one, then evenly spread times until there are ``target``.

    The choice depends on what was chosen before, so it is one fold over the array.
    """
    none = F.array().cast("array<double>")
    gap = F.lit(least_gap) if isinstance(least_gap, float) else least_gap
    far = lambda kept, t: ~F.exists(kept, lambda k: F.abs(k - t) < gap)
    flips = F.filter(F.transform(flags, lambda x, i: F.struct(x.t.alias("t"), ((i > 0) & (F.get(flags, i - 1).flag != x.flag)).alias("flip"))), lambda x: x.flip)
    kept = F.aggregate(flips, none, lambda acc, x: F.when((F.size(acc) == 0) | (x.t - F.element_at(acc, -1) >= gap), F.concat(acc, F.array(x.t))).otherwise(acc))
    n = F.size(flags)
    spread = F.transform(F.sequence(F.lit(0), F.lit(target - 1)), lambda i: F.get(flags, F.floor(i * n / target).cast("int")).t)
    return F.when(n > 0, F.array_sort(F.aggregate(spread, kept, lambda acc, t: F.when((F.size(acc) < target) & far(acc, t), F.concat(acc, F.array(t))).otherwise(acc)))).otherwise(none)


def presence_filter(windows: DataFrame, flags: DataFrame, track: str, width: int, most_absent: int = 3) -> DataFrame:
    """Windows (track, window_id) with at most ``most_absent`` frames flagged absent; frames without a flag count as absent."""
    spread = windows.select(track, "window_id", F.explode(F.sequence(F.col("window_id"), F.col("window_id") + width - 1)).alias("f"))
    counted = spread.join(flags.select(track, "f", "present"), [track, "f"], "left").groupBy(track, "window_id").agg(F.count_if(~F.coalesce("present", F.lit(False))).alias("absent"))
    return counted.filter(F.col("absent") <= most_absent)


def even_split(items: Column, parts: int) -> Column:
    """Cut an array into ``parts`` at rint(k * n / parts)."""
    n = F.size(items)
    at = lambda k: F.rint(k * n / F.lit(float(parts))).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.slice(items, at(k) + 1, at(k + 1) - at(k)))


def padded_chunks(states: Column, width: int) -> Column:
    """Cut an array into chunks of ``width``; the last is padded with its last entry."""
    n = F.size(states)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(width)), lambda i: F.slice(states, i, width))
    return F.when(n > 0, F.transform(cut, lambda c: F.concat(c, F.array_repeat(F.element_at(c, -1), F.lit(width) - F.size(c))))).otherwise(F.slice(cut, 1, 0))


def sampled_chunks(fr: DataFrame, track: str, width: int, stride: int, keyframe: int) -> DataFrame:
    """(track, chunk, keyframes, frames): every ``stride``-th frame, ``width`` to a chunk, the last chunk filled up with its last frame; ``keyframes`` counts the chunk's multiples of ``keyframe``."""
    chunk = F.floor(F.col("f") / (width * stride))
    taken = F.array_sort(F.collect_list(F.when(F.col("f") % stride == 0, F.col("f"))))
    c = fr.groupBy(track, chunk.alias("chunk")).agg(F.count_if(F.col("f") % keyframe == 0).alias("keyframes"), taken.alias("taken"))
    return c.select(track, "chunk", "keyframes", F.concat("taken", F.array_repeat(F.element_at("taken", -1), F.lit(width) - F.size("taken"))).alias("frames"))
