"""Product codes of vectors, with codebooks refined by a Lloyd iteration that is maintained by differences.

Components become integers, so sums, means and distances are exact and do not
depend on the order of rows.  A vector is cut into PARTS parts; each part has a
codebook of its own, which starts as that part of the vectors with the smallest
ids.

The written state holds, for every row, its integers, its assignment and the
one before.  The driver holds the running sums and counts of all entries
(PARTS x ENTRIES, whatever the table's size).  A round assigns every part to its
nearest entry and writes the state; then only parts whose assignment changed
contribute: they are added to their new entry and taken from the old one, first
within a task, and what tasks made of it is shuffled and added to the running
sums.  So what a round shuffles shrinks with what it moves, and ends when
nothing moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import reach_workers
from .common import discard, join_counted, materialise
from .vectors import floored, matrix

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Floors beyond this count as this, so that squared distances of whole vectors stay exact in 64 bits.
LIMIT = 1 << 26
#: Rows whose distances to all entries are held at once.
ROWS_AT_ONCE = 2_048


class Codebooks:
    """Entries (parts, entries, width) with the running sums and counts of what is assigned to each."""

    def __init__(self, first: np.ndarray):
        self.entries = first
        self.sums = np.zeros_like(first)
        self.counts = np.zeros(first.shape[:2], np.int64)

    def move(self, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the contributions of a round; each used entry becomes the floor of its mean."""
        self.sums += sums
        self.counts += counts
        used = self.counts > 0
        self.entries[used] = self.sums[used] // self.counts[used][:, None]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``parts`` (rows, parts, width) the nearest entry, ties to the lower index, and the squared distance: (rows, parts) each."""
    largest = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if parts.shape[2] * int(largest) ** 2 < 1 << 50 else np.int64  # exact either way; products in floating point are faster
    turned = entries.transpose(0, 2, 1).astype(kind)
    norms = (entries**2).sum(2)[:, None, :]
    code, error = np.empty(parts.shape[:2], np.int64), np.empty(parts.shape[:2], np.int64)
    for at in range(0, len(parts), ROWS_AT_ONCE):
        own = parts[at : at + ROWS_AT_ONCE].transpose(1, 0, 2)
        far = norms - 2 * (own.astype(kind) @ turned)
        best = far.argmin(2)
        code[at : at + ROWS_AT_ONCE] = best.T
        error[at : at + ROWS_AT_ONCE] = (np.take_along_axis(far, best[:, :, None], 2)[:, :, 0].astype(np.int64) + (own**2).sum(2)).T
    return code, error


def contributions(parts: np.ndarray, before: np.ndarray | None, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts by part and entry of what was added, less what was taken away."""
    _, many, width = parts.shape
    sums, counts = np.zeros((many, entries, width), np.int64), np.zeros((many, entries), np.int64)
    for j in range(many):
        moved = slice(None) if before is None else before[:, j] != code[:, j]
        for sign, at in ((1, code[moved, j]), *(() if before is None else ((-1, before[moved, j]),))):
            counts[j] += sign * np.bincount(at, minlength=entries)
            for k in range(width):
                sums[j, :, k] += sign * np.bincount(at, parts[moved, j, k], entries).astype(np.int64)  # whole numbers under 2 ** 53
    return sums, counts


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1).astype(np.int64)


def _bytes(code: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary())


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` for every usable row.

    Vectors that are null, empty or hold null or non-finite components are
    dropped, and so are those of another length than most.  A length that
    ``parts`` doesn't divide is filled up with zeros.  With fewer rows than
    ``entries`` there are as many entries as rows.  Repeated rows each count,
    also among the first entries, where equal ids are ordered by vector and
    rows with a null id come last.  Equal labels, nulls together, share the
    sum of their errors.  An empty table gives no rows; other columns are not
    read, whatever their names.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index must fit in a byte")
    spark = vectors.sparkSession
    reach_workers(spark)
    rows, d = floored(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")), "v", scale, LIMIT, "int")
    if not d:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    width = -(-d // parts)

    def cut(x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, parts * width - d))).reshape(len(x), parts, width)

    state = materialise(rows.withColumn("code", F.lit(None).cast("binary")), "codes")
    first = state.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # entries rows
    books = Codebooks(np.ascontiguousarray(cut(np.array([r.x for r in first], np.int64)).transpose(1, 0, 2)))
    count, size = len(first), parts * len(first) * (width + 1)
    kept = [state.schema[n] for n in ("vec_id", "label", "x")]

    def assign(df: DataFrame, now: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    code, _ = nearest(cut(matrix(batch.column("x"), d)), now)
                    columns = [batch.column(n) for n in ("vec_id", "label", "x", "code")]
                    yield pa.RecordBatch.from_arrays([*columns, _bytes(code)], names=["vec_id", "label", "x", "before", "code"])

        return df.mapInArrow(run, StructType([*kept, StructField("before", BinaryType()), StructField("code", BinaryType())]))

    def changes(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
            for batch in batches:
                if batch.num_rows:
                    old = batch.column("before")
                    more = contributions(cut(matrix(batch.column("x"), d)), None if old.null_count else _codes(old), _codes(batch.column("code")), count)
                    sums, counts = sums + more[0], counts + more[1]
            flat = np.concatenate([sums, counts[:, :, None]], 2).ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "change"])

        moved = df.filter("before is null or before <> code").select("x", "before", "code")
        flat = np.zeros(size, np.int64)
        for r in moved.mapInArrow(run, "at long, change long").groupBy("at").agg(F.sum("change").alias("change")).collect():  # size rows at most
            flat[r["at"]] = r["change"]
        cube = flat.reshape(parts, count, width + 1)
        return cube[:, :, :width], cube[:, :, width]

    for _ in range(rounds):
        before, state = state, materialise(assign(state.select("vec_id", "label", "x", "code"), books.entries.copy()), "codes")
        discard(before)
        books.move(*changes(state))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, error = nearest(cut(matrix(batch.column("x"), d)), books.entries)
                hexes = pa.array([r.tobytes().hex() for r in code.astype(np.uint8)])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), hexes, pa.array(error.sum(1))], names=["vec_id", "label", "code", "error"])

    schema = StructType([*kept[:2], StructField("code", StringType()), StructField("error", LongType())])
    coded = materialise(state.select("vec_id", "label", "x").mapInArrow(final, schema), "coded")
    discard(state)
    keyed = coded.withColumns({"no_label": F.col("label").isNull(), "label": F.coalesce(F.col("label").cast("string"), F.lit(""))})
    labels = keyed.groupBy("no_label", "label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    out = join_counted(keyed, materialise(labels, "labels"), ["no_label", "label"], keyed.count())
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
