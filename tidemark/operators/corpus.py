"""Splits, oversampling, dictionaries, shards and set comparison."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.sampling import hash_uniform
from ..functions.tokens import words
from ..session import written

#: Different n-grams that a task combines before it hands them on, characters of text for a partition of their exchange, words handed on at once.
GRAMS_AT_ONCE, CHARS_A_SLICE, WORDS_AT_ONCE = 400_000, 16_000_000, 50_000

#: What ``tokens.words`` takes for a word.
_WORD = re.compile(r"[^ \t\n\x0b\f\r]+")


def split_units(units: DataFrame, key: str, ratio: float, seed: str, rounding: str = "max1") -> DataFrame:
    """``split`` for every distinct unit: the first ``count`` units in hash order are test.

    ``count`` is max(1, int(n * ratio)) ("max1"), int(n * ratio) ("floor") or
    round(n * ratio) ("round").  Where that rank lies is found from counts of
    the hash's upper and lower 16 bits, so no task sorts the units; equal
    hashes are told apart by the key.  All rows of a unit fall on one side.
    """
    ids = units.select(key).distinct().withColumn("u", (hash_uniform(F.col(key), seed) * 4294967296.0).cast("bigint"))
    place, test = {}, F.lit(False)
    for bits in (16, 0):
        inside = ids.filter(F.shiftright("u", 16) == place[16]) if place else ids
        counts = sorted(inside.groupBy(F.shiftright("u", bits).alias("b")).count().collect())  # 65,536 rows at most
        if not place:
            n = sum(r["count"] for r in counts)
            left = {"max1": max(1, int(n * ratio)), "floor": int(n * ratio), "round": round(n * ratio)}[rounding]
        for r in counts:
            place[bits] = r.b
            if r["count"] >= left:
                break
            left -= r["count"]
    if place:
        ties = sorted(r[0] for r in ids.filter(F.col("u") == place[0]).select(key).collect())[:left]  # units with one hash
        test = (F.col("u") < place[0]) | ((F.col("u") == place[0]) & F.col(key).isin(ties))
    return ids.select(key, F.when(test, "test").otherwise("train").alias("split"))


def oversample(rows: DataFrame, id_col: str, times: int) -> DataFrame:
    """Every row ``times`` times with ids ``id_os0`` ..."""
    return rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn(id_col, F.concat(F.col(id_col).cast("string"), F.lit("_os"), F.col("_k"))).drop("_k")


def base_id(id_col: Column) -> Column:
    return F.regexp_replace(id_col, r"_os\d+$", "")


def first_wins(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One ``value`` per key, the first by ``order``, and how many collided with it."""
    return rows.groupBy(*keys).agg(F.min_by(value, order).alias(value), (F.count("*") - 1).alias("collisions"))


def concat_wins(rows: DataFrame, keys: list[str], value: str, order: str, sep: str = " ") -> DataFrame:
    """All values of a key in order, joined."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x.v), sep).alias(value))


def longest_prefix(rows: DataFrame, name: str, prefixes: DataFrame, prefix: str, value: str, strict: bool = False) -> DataFrame:
    """``value`` of the longest prefix of each row's ``name``, or null; with ``strict`` a name without one raises.

    Each name is cut at the lengths that prefixes have, which makes an equi
    join; lengths are few.
    """
    lengths = [r[0] for r in prefixes.select(F.length(prefix)).distinct().orderBy(F.desc(F.length(prefix))).collect()]
    out = rows.withColumn("_best", F.lit(None).cast(prefixes.schema[value].dataType))
    for i, n in enumerate(lengths):
        of_length = prefixes.filter(F.length(prefix) == n).select(F.col(prefix).alias(f"_p{i}"), F.col(value).alias(f"_v{i}"))
        out = out.join(of_length, F.substring(name, 1, n) == F.col(f"_p{i}"), "left").withColumn("_best", F.coalesce("_best", f"_v{i}")).drop(f"_p{i}", f"_v{i}")
    if strict:
        missing = F.raise_error(F.concat(F.lit("no prefix fits "), F.col(name))).cast(prefixes.schema[value].dataType)
        out = out.withColumn("_best", F.coalesce("_best", missing))
    return out.withColumnRenamed("_best", value)


def split_by_shard(shard: Column, test: tuple[int, ...]) -> Column:
    """``test`` for the shards named so, else ``train``."""
    return F.when(shard.isin(*test), "test").otherwise("train")


def size_shards(rows: DataFrame, order: str, size: str, limit: int, slices: int | None = None) -> DataFrame:
    """``shard`` by running size in ``order``: a new shard every ``limit``.

    Rows are dealt by ranges of ``order`` (``slices`` of them; the session's
    partitions if not given), sorted and written once; running sums are taken
    within a range and shifted by the totals before, so no task sees all rows.
    """
    slices = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(slices, order).sortWithinPartitions(order)
    ranged = written(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    totals = ranged.groupBy("_slice").agg(F.sum(size).alias("_t"))
    before = totals.withColumn("_skip", F.coalesce(F.sum("_t").over(Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_t")  # a row for each range
    inside = F.sum(size).over(Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    out = ranged.withColumn("_sum", inside).join(F.broadcast(before), "_slice")
    return out.withColumn("shard", F.floor((F.col("_sum") + F.col("_skip") - F.col(size)) / limit).cast("bigint")).select(*rows.columns, "shard")


def count_ngrams(docs: DataFrame, text: str, n: int = 3, last: bool = True, most: int = GRAMS_AT_ONCE) -> DataFrame:
    """(gram, n, docs): how often each n-gram of words occurs and in how many rows; without ``last``, the last of each text is left out.

    A task combines its texts' grams up to ``most`` different ones (and those
    of one text) before it hands them on, so it holds no more however large it
    is.  They are dealt by hash, many to a row, which saves a row's bytes for
    each.  The exchange has more partitions for more characters, so none
    outgrows the memory.
    """
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    slices = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_A_SLICE))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: Counter = Counter()
        again: Counter = Counter()  # occurrences after the first of a text

        def made() -> pa.RecordBatch:
            part = np.fromiter((crc32(gram) % (4 * slices) for gram in times), np.int64, len(times))
            order = np.argsort(part, kind="stable")
            parts, starts = np.unique(part[order], return_index=True)
            listed = lambda values: pa.ListArray.from_arrays(pa.array([*starts, len(order)], pa.int32()), values.take(pa.array(order)))
            count = np.fromiter(times.values(), np.int64, len(times))
            more = np.fromiter(map(again.__getitem__, times), np.int64, len(times)) if again else 0
            grams = pc.binary_join(listed(pa.array(times, pa.binary())), b"\n").cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array(parts), grams, listed(pa.array(count)), listed(pa.array(count - more))], ["part", "grams", "n", "docs"])

        for batch in batches:
            for raw in batch.column(0):
                w = (raw.as_py() or b"").split()  # bytes are cut at ASCII white space only, as by tokens.words
                if not last:
                    w = w[:-1]
                grams = list(map(b" ".join, zip(*(w[i:] for i in range(n)), strict=False)))
                times.update(grams)
                if len(set(grams)) < len(grams):
                    again.update({g: c - 1 for g, c in Counter(grams).items() if c > 1})
                if len(times) >= most:
                    yield made()
                    times.clear()
                    again.clear()
        if times:
            yield made()

    packed = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(combine, "part bigint, grams string, n array<bigint>, docs array<bigint>")
    dealt = packed.repartition(slices, "part").select("part", F.explode(F.arrays_zip(F.split("grams", "\n").alias("gram"), "n", "docs")).alias("x"))
    return dealt.groupBy("part", "x.gram").agg(F.sum("x.n").alias("n"), F.sum("x.docs").alias("docs")).drop("part")


def drop_repeated_ngrams(docs: DataFrame, key: str, text: str, n: int = 3, dull: tuple[str, ...] = ()) -> DataFrame:
    """(key, at, word): words in order, without those inside later copies of an n-gram that the text has before.

    A copy counts from where the first one ends, and only if the n-gram has a
    word of more than three letters that is not in ``dull``.  Every text is
    read where it lies; words are handed on by number.
    """
    kind = StructType([docs.schema[key], StructField("at", IntegerType()), StructField("word", StringType())])

    def left(w: list[str]) -> list[int]:
        grams = list(zip(*(w[i:] for i in range(n)), strict=False))
        if len(set(grams)) == len(grams):
            return list(range(len(w)))
        first: dict[tuple, int] = {}
        kept, end = [], 0  # up to where words are gone
        for i, gram in enumerate(grams):
            if i >= first.setdefault(gram, i) + n and any(len(x) > 3 and x.lower() not in dull for x in gram):
                end = i + n
            if i >= end:
                kept.append(i)
        return kept + list(range(max(end, len(grams)), len(w)))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            of: list[int] = []
            words: list[str] = []
            for r, t in enumerate(batch.column(1)):
                w = _WORD.findall(t.as_py() or "")
                kept = left(w)
                at += kept
                of += [r] * len(kept)
                words += w if len(kept) == len(w) else [w[i] for i in kept]
                if len(at) >= WORDS_AT_ONCE or r == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int32())), pa.array(at, pa.int32()), pa.array(words, pa.string())], [key, "at", "word"])
                    at, of, words = [], [], []

    return docs.select(key, text).mapInArrow(drop, kind)


def compare_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of both id sets, of what they share, and its share of each in percent."""
    sides = a.select(key).distinct().withColumn("a", F.lit(1)).unionByName(b.select(key).distinct().withColumn("b", F.lit(1)), allowMissingColumns=True)
    counted = sides.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b")).agg(F.count("a").alias("n_a"), F.count("b").alias("n_b"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n_both"))
    return counted.select("n_a", "n_b", "n_both", F.round(100.0 * F.col("n_both") / F.col("n_a"), 4).alias("pct_a"), F.round(100.0 * F.col("n_both") / F.col("n_b"), 4).alias("pct_b"))


def labelled_union(parts: dict[str, DataFrame]) -> DataFrame:
    """All parts one after the other with their names in ``source``; columns that a part lacks are null."""
    out = None
    for name, part in parts.items():
        part = part.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def token_modes(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Words of each text by kind (seed2, cosmos, snac, caption, speech, agent), one row per key and kind.

    Between its tags every word counts as caption or speech, and the tags
    too; what no other kind claims is agent.  The mode at a word is the last
    caption or speech tag before it, so windows by key do the work.
    """
    w = texts.select(key, F.posexplode(words(F.col(text))).alias("at", "w"))
    tag = F.when(F.col("w").rlike("^</?(caption|speech)>$"), F.col("w"))
    before = F.last(tag, ignorenulls=True).over(Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    name = lambda c: F.regexp_extract(c, "(caption|speech)", 1)
    kind = F.when(tag.isNotNull(), name(F.col("w"))).when(before.isin("<caption>", "<speech>"), name(before))
    for k, pattern in (("seed2", "^</?seed2>$|^<seed2_"), ("cosmos", "^</?cosmos>$|^<cosmos_"), ("snac", "^</?(snac|listen|speak)>$|^<snac_")):
        kind = kind.when(F.col("w").rlike(pattern), k)
    return w.select(key, kind.otherwise("agent").alias("kind")).groupBy(key, "kind").agg(F.count("*").alias("n"))


def grouped_percentile(rows: DataFrame, group: str, value: str, share: float, bins: int = 4096) -> DataFrame:
    """(group, percentile): exact, linear between ranks, without sorting or holding a group.

    A histogram of each group, combined before its shuffle, tells in which bins
    the two ranks lie and how many values come before; only those bins' values
    are ranked.
    """
    d = rows.select(group, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    span = d.groupBy(group).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    width = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins).otherwise(F.lit(1.0))
    binned = d.join(span, group).withColumn("_bin", F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)))
    rank = (F.col("_n") - 1) * F.lit(share)
    counts = binned.groupBy(group, "_bin").agg(F.count("*").alias("_c"), F.max("_n").alias("_n"))
    end = F.sum("_c").over(Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    wanted = counts.withColumn("_end", end).withColumn("_skip", F.col("_end") - F.col("_c"))
    wanted = wanted.filter((F.col("_end") > F.floor(rank)) & (F.col("_skip") <= F.ceil(rank))).select(group, "_bin", "_skip", "_n")
    inside = binned.drop("_n").join(wanted, [group, "_bin"])
    place = F.row_number().over(Window.partitionBy(group, "_bin").orderBy("_v")) - 1 + F.col("_skip")
    ends = inside.withColumn("_at", place).filter((F.col("_at") == F.floor(rank)) | (F.col("_at") == F.ceil(rank)))
    low, high = F.min("_v"), F.max("_v")
    return ends.groupBy(group).agg((low + (high - low) * (F.max(rank) - F.floor(F.max(rank)))).alias("percentile"))
