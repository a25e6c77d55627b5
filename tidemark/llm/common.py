"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_path, reach_workers

#: Bytes that separate words; all are ASCII, so UTF-8 bytes can be cut at them.
WORD_SPACES = b" \t\n\x0b\x0c\r"

#: A key is hot if more rows have it than HOT_ROWS and than one in HOT_SHARE of all.
HOT_ROWS, HOT_SHARE = 1_000, 1_000

#: Input rows handled by one numpy pass at most; bounds what a Python worker holds.
ROWS_AT_ONCE = 512


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files that ``materialise`` wrote for ``df``, which is not read again."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/tidemark-" in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_counted(rows: DataFrame, one: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` joined on ``keys`` with ``one``, which has each key once and in ``n`` how many of the ``total`` rows have it.

    Keys of more than HOT_ROWS rows and of more than one row in HOT_SHARE are
    broadcast: there are at most HOT_SHARE of them, and their rows stay where
    they are, so no key fills one task.  ``n`` is left out.
    """
    most = max(HOT_ROWS, total // HOT_SHARE)
    hot = one.filter(F.col("n") > most).drop("n")
    if hot.isEmpty():
        return rows.join(one.drop("n"), keys)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(one.filter(F.col("n") <= most).drop("n"), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def map_rows(df: DataFrame, columns: Iterable[str], fn: Callable[..., Iterable[tuple]], schema: str, setup: Callable[[], Any] | None = None) -> DataFrame:
    """Run ``fn`` over slices of at most ROWS_AT_ONCE rows, in Arrow batches.

    ``fn`` gets one Python list per column (after what ``setup`` made, if
    given) and yields rows of ``schema``.  Only ``columns`` are sent to Python.
    """
    columns = list(columns)
    reach_workers(df.sparkSession)
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = () if setup is None else (setup(),)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows = list(fn(*head, *(part.column(i).to_pylist() for i in range(len(columns)))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def map_arrays(df: DataFrame, columns: Iterable[str], fn: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """As ``map_rows``, for an ``fn`` that yields whole columns (arrays or lists) instead of rows."""
    columns = list(columns)
    reach_workers(df.sparkSession)
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                for made in fn(*(part.column(i).to_pylist() for i in range(len(columns)))):
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(made, out, strict=True)], schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32())}
    return pa.schema([pa.field(*(lambda p: (p[0], kinds[p[1]]))(x.split())) for x in ddl.split(", ")])


#: Longest text that a Cache keeps, in characters.
LONGEST_KEPT = 64


class Cache(dict):
    """A dict of bounded size in two generations: what was used since the last turn outlives it.

    ``make`` computes a missing value.  ``turn``, called between slices of
    rows, makes the young generation the old one when it holds ``limit``
    entries; the old one goes.  Texts over LONGEST_KEPT characters are not
    kept, so entries are of bounded size too.
    """

    def __init__(self, make: Callable[[Any], Any] | None = None, limit: int = 500_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def turn(self) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = value
        return value
