"""Near-duplicate groups by min-max hashing.

A document is the set of its distinct word shingles.  Under each of
PERMUTATIONS hash functions both the smallest and the largest value of the set
are kept, which gives two signature values per hash evaluation.  Four values
make a band; documents that agree on a band are candidates.  Two sets with a
similarity of 0.75 miss each other in all 32 bands with a probability of about
5e-6.  Every link is confirmed on the full sets.

Documents with equal sets count as one class from the start.  What is sought
is connectivity, so not all pairs of a bucket are looked at:

1. each class of a bucket is compared with the bucket's smallest, and the
   confirmed links give components;
2. only in buckets that still hold several components, classes of different
   components are compared by longer sketches (the low byte of each of 1,024
   signature values), and pairs with enough agreement are confirmed too.  Sets
   of up to KEPT_SHINGLES come along with the sketches, so the task of the
   bucket confirms such a pair itself and counts the two components as one from
   then on: it gives fewer links than it has classes, however many pairs are
   nearly similar.  Only pairs with a larger set leave it unconfirmed.

In buckets of more than BUCKET_ROWS classes not all pairs are compared, however
large a family of half-similar documents is: their classes are met again by
prefix filtering, which loses no link.  Shingles are ordered from the rarest to
the most frequent; two sets as similar as wanted have one in common among the
first ``n - ceil(0.75 n) + 1`` of the larger and the first
``n - ceil(1.5 n / 1.75) + 1`` of the smaller.  So only classes that share a
rare shingle are compared, and what a large family has in common, which is
frequent, brings nobody together.  A shingle with more than BUCKET_ROWS classes
even so is cut into blocks of about that size, each a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import join_counted, map_arrays, map_rows, materialise
from .components import connected_components
from .rolling import mix, roll, word_hashes

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
PERMUTATIONS, BANDS = 64, 32
#: Classes whose pairs one task compares: those of a bucket, or of a block.
BUCKET_ROWS = 2_000
#: Pairs with one class that are confirmed beside one copy of its text.
PAIRS_AT_ONCE = 500
#: Sketches hold two values of each of so many permutations.
SKETCH_PERMUTATIONS = 512
#: Agreeing sketch values, of the first 128 and of all 1,024, from which a pair is confirmed on full sets.  A similarity of 0.75 gives 96 and 768 on average; these are 6 and 5.2 deviations less.
FIRST_LEAST, SKETCH_LEAST = 66, 696

#: Shingles of a set that is sent along with its sketch (8 bytes each).
KEPT_SHINGLES = 2_048

_draw = np.random.default_rng(20240229)
_A = _draw.integers(0, 1 << 63, SKETCH_PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, SKETCH_PERMUTATIONS, np.uint64)
_BAND_NUMBER = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a shorter text is one shingle, one without words has none."""
    found = word_hashes((text or "").encode().lower().split())
    if not len(found):
        return found
    return np.unique(roll(found, words)) if len(found) >= words else roll(found, len(found)) ^ np.uint64(len(found))


def signature(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Smallest and largest value under every permutation, alternating."""
    low, high = np.full(permutations, ~np.uint64(0)), np.zeros(permutations, np.uint64)
    for at in range(0, len(shingles), 4096):
        values = shingles[at : at + 4096, None] * _A[:permutations] + _B[:permutations]
        low, high = np.minimum(low, values.min(0)), np.maximum(high, values.max(0))
    return np.stack([low, high], 1).ravel()


def bands(values: np.ndarray) -> np.ndarray:
    """One hash per band of four values, different for each band."""
    rows = values.reshape(BANDS, -1)
    out = _BAND_NUMBER
    for j in range(rows.shape[1]):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + rows[:, j])
    return out.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY_PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sizes_fit(a: str, b: str, percent: int) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar; ``texts`` has ``rep`` and ``text``.

    The pairs of one ``a`` are cut into slots of about PAIRS_AT_ONCE; each slot
    gets the text of ``a`` once, before the texts of its ``b``.
    """
    pairs = materialise(pairs, "pairs")
    many = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("slots", F.ceil(F.col("n") / PAIRS_AT_ONCE))
    slotted = join_counted(pairs, many, ["a"], pairs.count()).select("a", "b", F.pmod(F.xxhash64("b"), "slots").alias("slot"))
    left = slotted.select("a", "slot").distinct().join(texts.withColumnRenamed("rep", "a"), "a").select("a", "slot", F.lit(None).cast("long").alias("b"), "text")
    right = slotted.join(texts.withColumnRenamed("rep", "b"), "b").select("a", "slot", "b", "text")
    dealt = left.unionByName(right).repartition("a", "slot").sortWithinPartitions("a", "slot", F.col("b").asc_nulls_first())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sets = None, []
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 64):  # texts can be long
                for a, slot, b, text in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    if b is None:
                        sets = [*sets, shingle_set(text, words)] if place == (a, slot) else [shingle_set(text, words)]
                        place = a, slot
                    else:
                        other = shingle_set(text, words)
                        if any(similar(x, other, percent) for x in sets):
                            found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], schema=schema)

    reach_workers(pairs.sparkSession)
    return dealt.mapInArrow(run, "a long, b long")


def sketch_pairs(members: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """Pairs (a, b) of different components whose sketches agree enough.

    A pair is ``sure`` if it is confirmed on the full sets; what such pairs
    connect is one component from there on.  Others have a set that is not at
    hand.  ``members`` has ``bucket``, ``rep``, ``n``, ``component``, ``sketch``,
    ``set`` (null if large), ``bands``, ``outer``, ``side`` and ``indexed``.  Pairs are those of one
    bucket whose sizes fit and of which the smaller by (n, rep) is
    ``indexed``; where ``side`` is 0 or 1 and not -1, those of two sides.  Where
    ``outer`` is set it is the band hash that makes the bucket, and a pair that
    shares several bands is looked at only in the bucket of the first.
    """
    reach_workers(members.sparkSession)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_())])

    def close(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        group.sort(key=lambda r: (r[2], r[1]))
        reps, sizes, comps, sides = (np.array([r[k] for r in group], np.int64) for k in (1, 2, 3, 7))
        sketches = np.frombuffer(b"".join(r[4] for r in group), np.uint8).reshape(len(group), -1)
        sets = [None if r[9] is None else np.frombuffer(r[9], np.uint64) for r in group]
        outer = group[0][6]
        hashes = None if outer is None else np.array([r[5] for r in group], np.int64)
        for i in range(len(group) - 1):
            if not group[i][8]:
                continue
            fits = (comps[i + 1 :] != comps[i]) & (100 * sizes[i] >= percent * sizes[i + 1 :])
            if sides[i] >= 0:
                fits &= sides[i + 1 :] != sides[i]
            near = np.flatnonzero(fits) + i + 1
            if outer is not None:
                common = hashes[near] == hashes[i]
                near = near[hashes[i][common.argmax(1)] == outer]
            near = near[(sketches[near, :128] == sketches[i, :128]).sum(1) >= FIRST_LEAST]
            near = near[(sketches[near] == sketches[i]).sum(1) >= SKETCH_LEAST]
            found = []
            for j in near:
                if sets[i] is None or sets[j] is None:
                    found.append((min(reps[i], reps[j]), max(reps[i], reps[j]), False))
                elif comps[i] != comps[j] and similar(sets[i], sets[j], percent):
                    found.append((min(reps[i], reps[j]), max(reps[i], reps[j]), True))
                    comps[comps == comps[j]] = comps[i]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # sets can be large
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    if group and group[0][0] != row[0]:
                        yield from close(group)
                        group = []
                    group.append(row)
        if group:
            yield from close(group)

    dealt = members.select("bucket", "rep", "n", "component", "sketch", "bands", "outer", "side", "indexed", "set").repartition(F.col("bucket")).sortWithinPartitions("bucket", "rep")
    return dealt.mapInArrow(run, "a long, b long, sure boolean")


def _mixed_buckets(members: DataFrame) -> DataFrame:
    """``bucket``, ``n`` (rows) of the buckets that hold several components."""
    found = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    return found.filter("low < high").select("bucket", "n")


def prefixes(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``bucket`` (a shingle hash), ``rep`` and ``indexed``: the rarest shingles of every text that it shares with another.

    A text of n shingles gives those among its first n - ceil(p n) + 1, rarest
    first; ``indexed`` are those among the first n - ceil(2 p n / (1 + p)) + 1.
    """

    def shingles(reps: list, bodies: list) -> Iterator[tuple]:
        sets = [shingle_set(t, words).view(np.int64) for t in bodies]
        sizes = np.array([len(s) for s in sets])
        yield np.repeat(np.array(reps), sizes), np.repeat(sizes, sizes), np.concatenate(sets)

    each = materialise(map_arrays(texts, ["rep", "text"], shingles, "rep long, size long, bucket long"), "shingles")
    count = materialise(each.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").withColumn("common", F.col("n")), "counts")
    shared = join_counted(each, count, ["bucket"], each.count())  # a shingle of one text only is rarer than these and joins nothing
    ranked = shared.groupBy("rep", "size").agg(F.array_sort(F.collect_list(F.struct("common", "bucket"))).alias("found"))
    size, own = F.col("size"), F.col("size") - F.size("found")
    probe = size - F.ceil(size * percent / 100) + 1 - own
    index = size - F.ceil(size * (2 * percent) / (100 + percent)) + 1 - own
    cut = ranked.select("rep", index.alias("index"), F.posexplode(F.slice("found", F.lit(1), F.greatest(probe, F.lit(0)).cast("int"))).alias("at", "x"))
    return cut.select("x.bucket", "rep", (F.col("at") < F.col("index")).alias("indexed"))


def meetings(lists: DataFrame, bucket_rows: int) -> DataFrame:
    """``lists`` (bucket, rep, component, indexed) as blocks of about ``bucket_rows`` rows for ``sketch_pairs``.

    In each block indexed rows (``side`` 0) meet rows of their bucket (1).
    Buckets with nothing to compare go.
    """
    each = F.lit(max(1, bucket_rows // 2))
    found = lists.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.count_if("indexed").alias("left"))
    found = materialise(found.filter("low < high and left > 0").select("bucket", "n", F.ceil(F.col("left") / each).alias("lefts"), F.ceil(F.col("n") / each).alias("rights")), "lists")
    cut = join_counted(lists, found, ["bucket"], lists.count())
    own = lambda parts: F.pmod(F.xxhash64("rep"), parts)
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
    left = cut.filter("indexed").withColumns({"l": own("lefts"), "side": F.lit(0)}).withColumn("r", every("rights"))
    right = cut.withColumns({"r": own("rights"), "side": F.lit(1), "indexed": F.lit(False)}).withColumn("l", every("lefts"))
    return left.unionByName(right).select(F.xxhash64("bucket", "l", "r").alias("bucket"), "rep", "component", "side", "indexed", F.lit(None).cast("long").alias("outer"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept`` for every row.

    Links join documents whose shingle sets have a Jaccard similarity of at
    least ``percent`` / 100.  Null, empty and blank texts have no shingles and
    are linked with nothing; neither are rows with a null id, whose component
    is null and which are kept.  Rows that share an id are one document.
    Texts of any length count whole; an empty table gives no rows; other
    columns are not read, whatever their names.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def sign(ids: list, texts: list) -> Iterator[tuple]:
        for i, text in zip(ids, texts, strict=True):
            found = shingle_set(text, words)
            if not len(found):
                yield i, 0, None, None
            else:
                yield i, len(found), xxhash.xxh3_128_digest(found.tobytes()), bands(signature(found))

    def sketch(reps: list, texts: list) -> Iterator[tuple]:
        for i, text in zip(reps, texts, strict=True):
            found = shingle_set(text, words)
            yield i, mix(signature(found, SKETCH_PERMUTATIONS)).astype(np.uint8).tobytes(), found.tobytes() if len(found) <= KEPT_SHINGLES else None

    signed = materialise(map_rows(base, ["doc_id", "text"], sign, "doc_id long, n long, set_key binary, bands array<long>"), "signed")
    linked = signed.filter("n > 0 and doc_id is not null")
    classes = linked.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("rows"))
    classes = materialise(classes, "classes")

    buckets = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    full = buckets.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("least"), F.max("rep").alias("high"), F.count("*").alias("rows")).filter("least.rep < high")
    full = materialise(full.select("bucket", "least", F.col("rows").alias("n")), "buckets")
    buckets = buckets.withColumnRenamed("n", "size")
    members = join_counted(buckets, full, ["bucket"], BANDS * classes.count())
    members = materialise(members.select("bucket", "rep", "size", F.col("least.rep").alias("least"), F.col("least.n").alias("least_n")), "members")
    texts = materialise(base.withColumnRenamed("doc_id", "rep").join(members.select("rep").distinct(), "rep", "left_semi"), "texts")

    stars = members.filter("rep <> least").filter(_sizes_fit("size", "least_n", percent)).select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    links = materialise(confirm(stars, texts, words, percent), "links")
    component = connected_components(links)

    def placed(rows: DataFrame, of: DataFrame) -> DataFrame:
        return rows.join(of.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    open_members = placed(members.select("bucket", "rep"), component)
    open_members = materialise(join_counted(open_members, _mixed_buckets(open_members).withColumn("many", F.col("n")), ["bucket"], members.count()), "open")
    sketches = map_rows(texts.join(open_members.select("rep").distinct(), "rep", "left_semi"), ["rep", "text"], sketch, "rep long, sketch binary, set binary")
    sketches = sketches.join(classes.select("rep", "n", "bands"), "rep").dropDuplicates(["rep"])
    small = open_members.filter(F.col("many") <= bucket_rows).select("bucket", "rep", "component", F.col("bucket").alias("outer"), F.lit(-1).alias("side"), F.lit(True).alias("indexed"))
    near = sketch_pairs(small.join(sketches, "rep"), percent)

    large = open_members.filter(F.col("many") > bucket_rows).select("rep", "component").distinct()
    if not large.isEmpty():
        met = materialise(prefixes(texts.join(large.select("rep"), "rep", "left_semi").dropDuplicates(["rep"]), words, percent).join(large, "rep"), "prefixes")
        near = near.unionByName(sketch_pairs(meetings(met, bucket_rows).join(sketches, "rep"), percent))
    near = materialise(near, "near")
    open_pairs = near.filter("not sure").select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    more = near.filter("sure").select("a", "b")
    more = materialise(more.unionByName(confirm(open_pairs, texts, words, percent)), "links")
    if not more.isEmpty():
        component = connected_components(links.unionByName(more))

    of_class = materialise(placed(classes.select("set_key", "rep", F.col("rows").alias("n")), component).select("set_key", "component", "n"), "of-class")
    in_class = F.col("n_shingles").isNotNull() & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    signed = signed.select("doc_id", F.col("n").alias("n_shingles"), "set_key")
    found = join_counted(signed.filter(in_class), of_class, ["set_key"], signed.count())
    out = found.unionByName(signed.filter(~in_class).withColumn("component", F.lit(None).cast("long")))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
