"""Near-duplicate groups by SimHash fingerprints, joined under the generalised pigeonhole principle.

Two fingerprints of 64 bits that differ in at most DIFFER bits are linked.  The
bits are cut into m partitions, and each fingerprint gives partition i a number
of units u_i, with a sum of DIFFER + 1.  Whatever is linked with it differs in
fewer than u_i bits in at least one partition i, else the differences would sum
up to DIFFER + 1.  So it is enough to look, in each partition with units, for
fingerprints that differ there in at most u_i - 1 bits: a partition may get
none, and be skipped, and another one several.

1. Bits that are correlated go into the same partition, so that what the others
   say is new.  The counts behind it come from all distinct fingerprints.
2. Cells of 16 bits have exact histograms (4 x 65,536 counts), hence the number
   of fingerprints within 0 to 3 bits of every value.  A partition is a cell or
   a pair of cells; the candidates of a pair are estimated as if its two cells
   were independent.
3. For every fingerprint dynamic programming finds the units that make the
   fewest candidates and probes.  Whether four partitions of a cell or two of a
   pair are used is decided by the sum of these costs, for the table as a whole;
   with more rows longer keys become the cheaper ones.
4. Every fingerprint stands under its own value of each partition and probes
   the values its units allow.  A value that no fingerprint has is not probed.
   Buckets are cut into blocks of bounded size, and what meets is verified by
   counting differing bits.

A block gives no list of pairs but a forest that joins what it links, so that a
thousand near copies give a thousand rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import join_counted, map_arrays, materialise
from .components import connected_components

BITS, DIFFER, SHINGLE_WORDS, SEED = 64, 3, 3, 42
#: Bits of a cell, and cells.
CELL, CELLS = 16, 4
#: Numbers of partitions to choose from: one cell each, or two.
PARTITIONS = (4, 2)
#: A probe costs as much as so many comparisons.
PROBE_COST = 64.0
#: Fingerprints and probes that meet in one block, each.
BLOCK_ROWS = 4_096
#: Pairs compared at once.
PAIRS_AT_ONCE = 1 << 20
#: Groups with at most so many pairs are compared together.
SMALL = 4_096

_U = DIFFER + 1
_SHIFTS = np.arange(0, BITS, CELL, dtype=np.uint64)


def _masks(width: int) -> list[np.ndarray]:
    """All values of ``width`` bits with at most 0, 1, .. DIFFER bits set."""
    out, found = [], [0]
    for many in range(_U):
        if many:
            found = found + [sum(1 << b for b in bits) for bits in combinations(range(width), many)]
        out.append(np.array(found, np.uint64))
    return out


_MASKS = {p: _masks(BITS // p) for p in PARTITIONS}


def fingerprints(texts: list[str | None], words: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of every text; zero for one without words."""
    found, sizes = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        split = (text or "").encode().lower().split()
        if split:
            shingles = map(b" ".join, zip(*(split[k:] for k in range(words)), strict=False)) if len(split) >= words else [b" ".join(split)]
            sizes[i] = max(1, len(split) - words + 1)
            found.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, int(sizes[i])))
    out = np.zeros(len(texts), np.uint64)
    have = np.flatnonzero(sizes)
    if not len(have):
        return out
    hashes, ends = np.concatenate(found), np.cumsum(sizes[have])
    counts = np.zeros((len(have), BITS), np.int64)
    step = 1 << 16
    for at in range(0, len(hashes), step):
        part = hashes[at : at + step]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        # runs of one text and of at most 255 rows, whose sums a byte holds
        cuts = np.union1d(np.arange(0, len(part), 255), (edges := ends - at)[(edges > 0) & (edges < len(part))])
        np.add.at(counts, np.searchsorted(ends, cuts + at, "right"), np.add.reduceat(bits, cuts, axis=0, dtype=np.uint8).astype(np.int64))
    out[have] = np.packbits(2 * counts > sizes[have, None], axis=1).view(">u8").ravel()
    return out


def _as_bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def permuted(prints: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Fingerprints with their bits in another order; differences stay as many."""
    bits = np.ascontiguousarray(_as_bits(prints)[:, order])
    return np.packbits(bits, axis=1).reshape(-1).view(">u8").astype(np.uint64)


def bit_order(together: np.ndarray, n: int) -> np.ndarray:
    """Bits by cells of correlated ones; ``together`` has how many of ``n`` fingerprints have bits i and j."""
    mean = together.diagonal() / max(n, 1)
    spread = np.sqrt(mean * (1 - mean))
    scale = np.outer(spread, spread)
    strength = np.divide(np.abs(together / max(n, 1) - np.outer(mean, mean)), scale, out=np.zeros_like(scale), where=scale > 1e-9)
    np.fill_diagonal(strength, 0)
    left, out = list(range(BITS)), []
    for _ in range(CELLS):
        cell = [max(left, key=lambda b: strength[b, left].sum())]
        left.remove(cell[0])
        while len(cell) < CELL:
            cell.append(max(left, key=lambda b, cell=cell: strength[b, cell].sum()))
            left.remove(cell[-1])
        out = cell + out  # the first cell has the lowest bits
    return np.array(out)


def at_distance(histogram: np.ndarray) -> np.ndarray:
    """(cells, DIFFER + 1, values): how many fingerprints differ from a value of a cell in exactly 0 .. DIFFER bits."""
    out = np.zeros((len(histogram), _U, histogram.shape[1]))
    out[:, 0] = histogram
    values = np.arange(histogram.shape[1])
    for bit in range(CELL):
        for d in range(DIFFER, 0, -1):
            out[:, d] += out[:, d - 1][:, values ^ (1 << bit)]
    return out


def _cells(prints: np.ndarray) -> np.ndarray:
    return ((prints[:, None] >> _SHIFTS) & np.uint64((1 << CELL) - 1)).astype(np.int64)


def costs(prints: np.ndarray, near: np.ndarray, n: int, partitions: int) -> np.ndarray:
    """(fingerprints, partitions, units 0 .. DIFFER + 1): estimated candidates and probes."""
    cells, each = _cells(prints), CELLS // partitions
    out = np.zeros((len(prints), partitions, _U + 1))
    probes = PROBE_COST * np.array([len(m) for m in _MASKS[partitions]])
    for i in range(partitions):
        found = near[i * each][:, cells[:, i * each]]
        for c in range(i * each + 1, (i + 1) * each):
            more = near[c][:, cells[:, c]] / max(n, 1)
            found = np.array([sum(found[k] * more[d - k] for k in range(d + 1)) for d in range(_U)])
        out[:, i, 1:] = found.cumsum(0).T + probes
    return out


def allocate(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units of every partition with the least total cost and a sum of DIFFER + 1, and that cost."""
    n, partitions, _ = price.shape
    best, taken = np.full((n, _U + 1), np.inf), []
    best[:, 0] = 0
    for i in range(partitions):
        options = np.full((n, _U + 1, _U + 1), np.inf)  # by sum and units of this partition
        for units in range(_U + 1):
            options[:, units:, units] = best[:, : _U + 1 - units] + price[:, i, units, None]
        taken.append(options.argmin(2))
        best = options.min(2)
    units, left = np.zeros((n, partitions), np.int64), np.full(n, _U)
    for i in range(partitions - 1, -1, -1):
        units[:, i] = taken[i][np.arange(n), left]
        left -= units[:, i]
    return units, best[:, _U]


def probes(prints: np.ndarray, units: np.ndarray, histogram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets to look into and fingerprints, in slices; buckets that the histogram shows to be empty are left out."""
    partitions = units.shape[1]
    width, each = BITS // partitions, CELLS // partitions
    for i in range(partitions):
        for many in range(1, _U + 1):
            chosen = prints[units[:, i] == many]
            masks = _MASKS[partitions][many - 1]
            step = max(1, PAIRS_AT_ONCE // len(masks))
            for at in range(0, len(chosen), step):
                part = chosen[at : at + step]
                values = ((part >> np.uint64(i * width)) & np.uint64((1 << width) - 1))[:, None] ^ masks
                some = np.ones(values.shape, bool)
                own = (masks == 0)[None]
                for c in range(each):  # under its own value stands the fingerprint itself
                    there = histogram[i * each + c][((values >> np.uint64(c * CELL)) & np.uint64((1 << CELL) - 1)).astype(np.int64)]
                    some &= there > own
                rows, cols = np.nonzero(some)
                yield (np.uint64(i << width) | values[rows, cols] if width < 64 else values[rows, cols]), part[rows]


def keys(prints: np.ndarray, partitions: int) -> list[np.ndarray]:
    """The bucket of every fingerprint in each partition."""
    width = BITS // partitions
    return [np.uint64(i << width) | ((prints >> np.uint64(i * width)) & np.uint64((1 << width) - 1)) for i in range(partitions)]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between nodes as a star from the least node of each component to the others."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        np.minimum.at(least, a, before[b])
        np.minimum.at(least, b, before[a])
        least = least[least]
        if (least == before).all():
            break
    others = np.flatnonzero(least < np.arange(len(nodes)))
    return nodes[least[others]], nodes[others]


def _joined(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of links between two lists, found breadth first."""
    near = np.empty((len(left), len(right)), bool)
    step = max(1, PAIRS_AT_ONCE // len(right))
    for at in range(0, len(left), step):
        near[at : at + step] = np.bitwise_count(left[at : at + step, None] ^ right) <= DIFFER
    todo, free = near.any(1), np.ones(len(right), bool)
    a, b = [left[:0]], [left[:0]]
    while todo.any():
        front = np.array([todo.argmax()])
        first = left[front[0]]
        while len(front):
            todo[front] = False
            met = np.flatnonzero(near[front].any(0) & free)
            free[met] = False
            rows = np.flatnonzero(todo)
            a += [np.full(len(front) + len(met), first)]
            b += [left[front], right[met]]
            front = rows[near[np.ix_(rows, met)].any(1)] if len(met) else rows[:0]
    return np.concatenate(a), np.concatenate(b)


def verified(starts: np.ndarray, sizes: np.ndarray, prints: np.ndarray, probing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as stars; each group has the rows that stand in its bucket before those that probe it."""
    asked = np.add.reduceat(probing.astype(np.int64), starts)
    held = sizes - asked
    pairs = held * asked
    a, b = [prints[:0]], [prints[:0]]
    small = np.flatnonzero((pairs > 0) & (pairs <= SMALL))
    cuts = np.flatnonzero(np.diff(pairs[small].cumsum() // PAIRS_AT_ONCE)) + 1
    for part in np.split(small, cuts):
        if len(part):
            many = pairs[part]
            at = np.arange(many.sum()) - np.repeat(many.cumsum() - many, many)
            first, width = np.repeat(starts[part], many), np.repeat(asked[part], many)
            x = prints[first + at // width]
            y = prints[first + np.repeat(held[part], many) + at % width]
            close = (x != y) & (np.bitwise_count(x ^ y) <= DIFFER)
            a.append(x[close])
            b.append(y[close])
    for g in np.flatnonzero(pairs > SMALL):
        own = prints[starts[g] : starts[g] + sizes[g]]
        x, y = _joined(own[: held[g]], own[held[g] :])
        a.append(x)
        b.append(y)
    return forest(np.concatenate(a), np.concatenate(b))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _links(prints: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """Links (a, b) between permuted fingerprints that join all whose differences are few, and the order of bits; ``prints`` has ``n`` distinct ``print``."""
    spark = prints.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            bits = _as_bits(_unsigned(batch.column(0))).astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS)), pa.array(total.ravel())], names=["at", "n"])

    together = np.zeros(BITS * BITS, np.int64)
    for r in prints.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # BITS * BITS rows
        together[r["at"]] = r["n"]
    order = bit_order(together.reshape(BITS, BITS), n)

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_signed(permuted(_unsigned(batch.column(0)), order))], names=["p"])

    placed = materialise(prints.mapInArrow(permute, "p long"), "permuted")
    cells = F.explode(F.array(*[F.lit(c << CELL).bitwiseOR(F.shiftrightunsigned("p", c * CELL).bitwiseAND((1 << CELL) - 1).cast("int")) for c in range(CELLS)]))
    table = placed.select(cells.alias("at")).groupBy("at").agg(F.count("*").alias("n")).toArrow()  # CELLS * 65,536 rows at most
    histogram = np.zeros(CELLS << CELL, np.int64)
    histogram[table["at"].to_numpy()] = table["n"].to_numpy()
    histogram = histogram.reshape(CELLS, -1)
    shared = spark.sparkContext.broadcast((histogram, at_distance(histogram)))  # 10 MB

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = shared.value[1]
        sums = [0.0] * len(PARTITIONS)
        for batch in batches:
            own = _unsigned(batch.column(0))
            for k, m in enumerate(PARTITIONS):
                sums[k] += float(allocate(costs(own, near, n, m))[1].sum())
        yield pa.RecordBatch.from_arrays([pa.array([s]) for s in sums], names=[f"c{m}" for m in PARTITIONS])

    sums = placed.mapInArrow(total, ", ".join(f"c{m} double" for m in PARTITIONS)).agg(*[F.sum(f"c{m}") for m in PARTITIONS]).first()
    partitions = PARTITIONS[int(np.argmin([s or 0.0 for s in sums]))]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, near = shared.value
        for batch in batches:
            own = _unsigned(batch.column(0))
            sides = [(k, own, False) for k in keys(own, partitions)]
            units = allocate(costs(own, near, n, partitions))[0]
            for bucket, p, probing in [*sides, *((b, p, True) for b, p in probes(own, units, held))]:
                if len(bucket):
                    yield pa.RecordBatch.from_arrays([_signed(bucket), _signed(p), pa.array(np.full(len(p), probing))], names=["bucket", "p", "probing"])

    dealt = materialise(placed.mapInArrow(deal, "bucket long, p long, probing boolean"), "probes")
    parts = lambda rows: F.ceil(F.col(rows) / BLOCK_ROWS)
    full = dealt.groupBy("bucket").agg(F.count_if("probing").alias("asked"), F.count_if(~F.col("probing")).alias("held")).filter("asked > 0 and held > 0")
    full = materialise(full.select("bucket", (F.col("asked") + F.col("held")).alias("n"), parts("asked").alias("asked"), parts("held").alias("held")), "buckets")
    cut = join_counted(dealt, full, ["bucket"], dealt.count())
    own, other = F.when(F.col("probing"), F.col("asked")).otherwise(F.col("held")), F.when(F.col("probing"), F.col("held")).otherwise(F.col("asked"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("p"), own)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), other - 1)))
    block = F.when(F.col("probing"), F.col("other") * F.col("asked") + F.col("own")).otherwise(F.col("own") * F.col("asked") + F.col("other"))
    blocks = cut.select("bucket", block.alias("block"), "p", "probing").repartition("bucket", "block").sortWithinPartitions("bucket", "block", "probing")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)]

        def link(bucket: np.ndarray, block: np.ndarray, p: np.ndarray, probing: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = verified(starts, np.diff([*starts, len(p)]), p, probing)
            if len(a):
                yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], names=["a", "b"])

        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), _unsigned(batch.column(2)), batch.column(3).to_numpy(zero_copy_only=False)]
            rest = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            if len(rest[0]):
                starts = np.flatnonzero(np.concatenate([[True], (np.diff(rest[0]) != 0) | (np.diff(rest[1]) != 0)]))
                if len(starts) > 1:
                    yield from link(*(x[: starts[-1]] for x in rest), starts[:-1])
                    rest = [x[starts[-1] :] for x in rest]
        if len(rest[0]):
            yield from link(*rest, np.zeros(1, np.int64))

    return blocks.mapInArrow(meet, "a long, b long"), order


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest id reachable over links) for every row.

    A bit of a fingerprint is set if it is set in over half the hashes of the
    text's word shingles, repeats included; a shorter text is one shingle.
    Null, empty and blank texts have the fingerprint zero and are linked like
    any other.  Rows with a null id have a fingerprint, no component and no
    links.  Rows that share an id are one document, with all its fingerprints.
    Texts of any length count whole; repeated rows give repeated rows; an empty
    table gives no rows; other columns are not read, whatever their names.
    """
    reach_workers(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def sign(ids: list, texts: list) -> Iterator[tuple]:
        yield ids, fingerprints(texts, words).view(np.int64)

    signed = materialise(map_arrays(base, ["doc_id", "text"], sign, "doc_id long, print long"), "prints")
    named = signed.filter("doc_id is not null")
    classes = materialise(named.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    links, order = _links(classes.select("print"), classes.count())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _signed(permuted(_unsigned(batch.column(0)), order))], names=[*batch.schema.names, "node"])

    placed = materialise(classes.mapInArrow(place, "print long, rep long, n long, node long"), "placed")
    several = named.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).filter("low < high")
    several = materialise(named.join(several.select("doc_id", "low"), "doc_id").select("print", "low").distinct(), "several")
    if not several.isEmpty():
        node = placed.select("print", "node")
        same = several.join(node.withColumnRenamed("node", "a"), "print").join(node.withColumnsRenamed({"print": "low", "node": "b"}), "low")
        links = links.unionByName(same.select("a", "b"))
    rooted = materialise(placed.join(connected_components(links), "node", "left").select("print", "rep", "n", F.coalesce("component", "node").alias("root")), "rooted")
    roots = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    of_class = join_counted(rooted.select("print", "root", F.col("n").alias("rows")), roots, ["root"], classes.count())
    out = join_counted(named, materialise(of_class.select("print", "component_id", F.col("rows").alias("n")), "of-class"), ["print"], signed.count())
    out = out.unionByName(signed.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long")))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
