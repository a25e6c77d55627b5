"""Operators on nested records, required fields, parallel arrays and reports of what a filter dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import VOCAB_LIMIT, over_limit_count, tags_balanced


def video_id(filename: Column, title: Column) -> Column:
    """The file's name without ``.mp4``; where it is null or empty, the title in lower case with ``_`` for spaces."""
    return F.when(F.coalesce(filename, F.lit("")) != "", F.replace(filename, F.lit(".mp4"), F.lit(""))).otherwise(F.replace(F.lower(title), F.lit(" "), F.lit("_")))


def explode_activities(videos: DataFrame, key: str = "video_id") -> DataFrame:
    """One row per activity with a valid time range: at least two entries and a positive duration.

    ``scenes`` is an array of (scene_id, activities), ``activities`` of
    structs with ``time_range``.  ``activity_id`` counts from 1 over all
    activities of the scene, those left out included.
    """
    a = videos.select(key, F.explode("scenes").alias("s")).select(key, F.col("s.scene_id").alias("scene_id"), F.posexplode("s.activities").alias("i", "activity"))
    span = F.col("activity.time_range")
    a = a.filter(F.size(span) >= 2).select("*", F.get(span, F.lit(0)).alias("start"), F.get(span, F.lit(1)).alias("end")).filter(F.col("end") > F.col("start"))
    name = F.concat(F.lit("scene_"), F.col("scene_id").cast("string"), F.lit("_act_"), (F.col("i") + 1).cast("string"))
    return a.select(key, "scene_id", name.alias("activity_id"), "start", "end", "activity")


def has_any_block(stream: Column, kinds: tuple[str, ...] = ("agent", "snac", "listen", "speak")) -> Column:
    """Whether a stream opens a block of any of ``kinds``."""
    found = F.lit(False)
    for k in kinds:
        found = found | F.contains(stream, F.lit(f"<{k}>"))
    return F.coalesce(found, F.lit(False))


def window_inside(start: Column, width: int, frames: Column) -> Column:
    """Whether a window of ``width`` frames lies inside a track of ``frames``."""
    return (start >= 0) & (start + width - 1 < frames)


def whole_window(window_id: Column, states: Column, stride: int, width: int) -> Column:
    """Whether a window is one of every ``stride``, has ``width`` frames and misses nothing in them."""
    missing = F.exists(states, lambda v: v.isNull() | F.isnan(v))
    return (F.pmod(window_id, F.lit(stride)) == 0) & (F.size(states) == width) & ~missing


def long_enough(start: Column, end: Column, least: float = 0.1) -> Column:
    """Segments of at least ``least`` seconds."""
    return end - start >= F.lit(least)


def filled(*columns: str) -> Column:
    """Whether all the columns are non-null and, without white space around, not empty."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    return out


def keep_report(rows: DataFrame, keep: Column, by: list[str]) -> DataFrame:
    """How many rows of each group a filter keeps and drops."""
    kept = F.coalesce(keep, F.lit(False))
    return rows.groupBy(*by).agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


def listed_without(rows: DataFrame, ids: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """Rows whose key is listed and whose text doesn't match ``pattern``, in order of the key; null texts stay."""
    return rows.join(ids.select(key).distinct(), key, "left_semi").filter(~F.coalesce(F.col(text).rlike(pattern), F.lit(False))).orderBy(key)


def parallel_records(rows: DataFrame, stem: str, index: str, arrays: list[str]) -> DataFrame:
    """Rows whose arrays have equal length, by entry: ``record_id`` is stem_index, ``at`` the entry's place."""
    same = F.lit(True)
    for a in arrays[1:]:
        same = same & (F.size(a) == F.size(arrays[0]))
    entries = F.posexplode(F.arrays_zip(*arrays)).alias("at", "e")
    name = F.concat_ws("_", F.col(stem).cast("string"), F.col(index).cast("string"))
    return rows.filter(same).select(name.alias("record_id"), entries).select("record_id", "at", *[F.col(f"e.{a}").alias(a) for a in arrays])


def joined_spans(texts: Column) -> Column:
    """The non-empty entries of an array of texts as paragraphs; null without any."""
    some = F.filter(texts, lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(some) > 0, F.array_join(some, "\n\n"))


def nth_record(rows: DataFrame, file: str, order: str, n: int) -> DataFrame:
    """The n-th record of every file, n from 1."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(file).orderBy(order))).filter(F.col("_n") == n).drop("_n")


def same_keys(entries: Column, names: tuple[str, ...]) -> Column:
    """Whether a map has exactly these keys."""
    return F.array_sort(F.map_keys(entries)) == F.array(*[F.lit(x) for x in sorted(names)])


def text_errors(lines: Column, field: str = "text") -> Column:
    """Errors of one JSON line: (bad_json, missing, tags, vocabulary).

    ``tags`` counts the block kinds whose opening and closing tags differ in
    number, ``vocabulary`` the ids at or over their family's limit.
    """
    bad = F.try_parse_json(lines).isNull()
    # a bare key test, as the value may be null
    missing = ~bad & ~F.coalesce(F.array_contains(F.json_object_keys(lines), field), F.lit(False))
    body = F.when(~bad & ~missing, F.coalesce(F.get_json_object(lines, f"$.{field}"), F.lit("")))
    tags = F.lit(0)
    for kind in VOCAB_LIMIT:
        tags = tags + F.coalesce((~tags_balanced(body, kind)).cast("int"), F.lit(0))
    return F.struct(bad.alias("bad_json"), missing.alias("missing"), tags.cast("bigint").alias("tags"), F.coalesce(over_limit_count(F.coalesce(body, F.lit(""))), F.lit(0)).cast("bigint").alias("vocabulary"))


def embedded_ids(metadata: Column, field: str = "id", length: int = 11) -> Column:
    """Ids of ``length`` characters inside JSON inside JSON: a list of objects whose ``params`` is a JSON text with ``field``."""
    outer = F.from_json(metadata, "array<struct<params:string>>")
    ids = F.transform(outer, lambda m: F.get_json_object(m.params, f"$.{field}"))
    return F.coalesce(F.filter(ids, lambda x: F.coalesce(F.length(x) == length, F.lit(False))), F.array().cast("array<string>"))


def token_arrays(records: DataFrame, key: str, record: str) -> DataFrame:
    """Entries of every numeric array in a field named ``*_token`` or ``*_tokens`` of a JSON record: (key, field, n)."""
    names = F.filter(F.coalesce(F.json_object_keys(record), F.array().cast("array<string>")), lambda k: k.rlike("_tokens?$"))
    each = records.select(key, F.explode(names).alias("field"), F.from_json(record, "map<string,string>").alias("m"))
    values = F.from_json(F.element_at("m", F.col("field")), "array<string>")
    numeric = F.coalesce(F.get(values, F.lit(0)).rlike(r"^-?[0-9]+(\.[0-9]+)?$"), F.lit(False))
    return each.filter(numeric).select(key, "field", F.size(values).cast("bigint").alias("n"))


def left_over_keys(right: DataFrame, left: DataFrame, key: str) -> DataFrame:
    """Keys that only the right side of a join has: what a left join leaves unreported."""
    return right.select(key).distinct().join(left.select(key).distinct(), key, "left_anti")


def shard_groups(wanted: DataFrame, manifest: DataFrame, key: str, shard: str, order: str) -> DataFrame:
    """What to read from each shard, so each is scanned once: ``shard``, ``n`` and the wanted keys in order.

    A key written to several shards is read from the last by ``order``.
    """
    last = manifest.groupBy(key).agg(F.max_by(shard, order).alias(shard))
    found = wanted.select(key).distinct().join(last, key)
    return found.groupBy(shard).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(key)).alias("keys"))
