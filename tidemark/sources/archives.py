"""Archives and binary records as DataFrames, over the sources of ``containers``."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reach_workers
from .containers import npy_header, opened, register

#: Rows are handed on when they are so many, or made of about so many bytes.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20


def read(spark: SparkSession, kind: str, path: str, **options: object) -> DataFrame:
    """A container source, with its members or records as rows."""
    register(spark)
    return spark.read.format(kind).options(**options).load(path)


def tar_members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Members of tar files, gzip or not, whose name ends with ``suffix``; archives inside are opened one level deep."""
    found = read(spark, "tar", path)
    return found.filter(F.col("member").endswith(suffix)) if suffix else found


def zip_members(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Members of zip files whose name matches ``pattern``, with its two groups ``category`` and ``seq_id``."""
    found = read(spark, "zip", path).filter(F.col("member").rlike(pattern))
    return found.select("path", "member", F.regexp_extract("member", pattern, 1).alias("category"), F.regexp_extract("member", pattern, 2).alias("seq_id"), "content")


def webdataset_pairs(records: DataFrame, members: DataFrame) -> DataFrame:
    """Records (``shard``, ``media``) joined to archive members of the same shard by file name."""
    m = members.select(F.regexp_extract("path", r"([^/]+)\.[^/.]+$", 1).alias("shard"), F.regexp_extract("member", "([^/]+)$", 1).alias("media"), "content")
    return records.join(m, ["shard", "media"], "left")


def npy_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``.npy`` arrays: ``path``, ``row``, ``shape`` of the whole and ``values``."""
    return read(spark, "npy", path)


def npy_shapes(spark: SparkSession, path: str) -> DataFrame:
    """Shape and element type of ``.npy`` files, from their headers alone."""
    reach_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", "true").load(path).select("path")  # contents are not read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            found = []
            for p in paths:
                with opened(p) as stream:
                    found.append(npy_header(stream))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([list(s) for s, *_ in found], pa.list_(pa.int64())), pa.array([str(k) for _, _, k, _ in found], pa.string())], names=["path", "shape", "kind"])

    return files.mapInArrow(run, "path string, shape array<bigint>, kind string")


def _each_record(records: DataFrame, fn: Callable[[bytes], Iterable[tuple]], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """Rows that ``fn`` makes of each record's ``content``, after its ``path`` and place."""
    reach_workers(records.sparkSession)
    kinds = [pa.string(), pa.int64(), *kinds]
    names = [c.split()[0] for c in schema.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for path, at, content in ((x.as_py() for x in row) for row in zip(*batch.columns, strict=True)):
                held += len(content)
                for row in fn(content):  # a record can give many rows for its bytes
                    rows.append((path, at, *row))
                    if len(rows) >= BATCH_ROWS:
                        yield made(rows)
                        rows, held = [], 0
                if rows and held >= BATCH_BYTES:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    return records.select("path", "at", "content").mapInArrow(run, schema)


def _base128(buf: bytes, at: int) -> tuple[int, int]:
    """A base-128 number of at most ten bytes and the place after it."""
    value = 0
    for i, b in enumerate(buf[at : at + 10]):
        value |= (b & 127) << (7 * i)
        if b < 128:
            return value, at + i + 1
    raise ValueError("number breaks off")


def fields(buf: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of every field of a protobuf message."""
    at, fixed = 0, {1: 8, 5: 4}
    while at < len(buf):
        tag, at = _base128(buf, at)
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _base128(buf, at)
        elif wire == 2 or wire in fixed:
            n, at = _base128(buf, at) if wire == 2 else (fixed[wire], at)
            if at + n > len(buf):
                raise ValueError("field breaks off")
            value, at = buf[at : at + n], at + n
        else:
            raise ValueError(f"wire type {wire}")
        yield number, wire, value


def walk(buf: bytes, most_depth: int = 6) -> dict[str, list]:
    """Every field of a message without its schema: lists of values by field number, in order.

    Bytes that read as a message are walked in turn, down to ``most_depth``;
    other bytes are text if they are UTF-8 that prints, else hex.
    """
    out: dict[str, list] = {}
    todo = [(out, buf, 1)]
    while todo:
        into, body, depth = todo.pop()
        for number, wire, value in fields(body):
            if wire == 2 and value and depth < most_depth and _is_message(value):
                shown: object = {}
                todo.append((shown, value, depth + 1))
            else:
                shown = value if isinstance(value, int) else _shown(value)
            into.setdefault(str(number), []).append(shown)
    return out


def _is_message(body: bytes) -> bool:
    try:
        return all(number > 0 for number, _, _ in fields(body))
    except ValueError:
        return False


def _shown(value: bytes) -> str:
    try:
        text = value.decode()
    except UnicodeDecodeError:
        return value.hex()
    return text if text.isprintable() else value.hex()


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _packed(body: bytes) -> Iterator[int]:
    at = 0
    while at < len(body):
        v, at = _base128(body, at)
        yield _signed(v)


def _feature(buf: bytes) -> tuple[str, list]:
    for kind, _, body in fields(buf):
        entries = [(wire, v) for _, wire, v in fields(body)]
        if kind == 1:
            return "bytes", [v.decode("utf-8", "replace") for _, v in entries]
        if kind == 2:
            return "float", [x for _, v in entries for x in np.frombuffer(v, "<f4").tolist()]
        return "int64", [x for wire, v in entries for x in ([_signed(v)] if wire == 0 else _packed(v))]
    return "empty", []


def sequence_example(buf: bytes) -> tuple[dict[str, tuple[str, list]], dict[str, list[tuple[str, list]]]]:
    """Context features and feature lists of a SequenceExample."""
    context, lists = {}, {}
    for number, _, body in fields(buf):
        for _, _, entry in fields(body):
            parts = {n: v for n, _, v in fields(entry)}
            key = parts.get(1, b"").decode()
            if number == 1:
                context[key] = _feature(parts.get(2, b""))
            else:
                lists[key] = [_feature(f) for _, _, f in fields(parts.get(2, b""))]
    return context, lists


def sequence_examples(spark: SparkSession, path: str) -> DataFrame:
    """TFRecord files of SequenceExamples, a row per feature: ``record`` (its place in the file), ``list`` (-1 for context), ``name``, ``kind``, ``values``."""

    def rows(content: bytes) -> Iterator[tuple]:
        context, lists = sequence_example(content)
        for name, (kind, values) in context.items():
            yield -1, name, kind, [str(v) for v in values]
        for name, steps in lists.items():
            for i, (kind, values) in enumerate(steps):
                yield i, name, kind, [str(v) for v in values]

    return _each_record(read(spark, "tfrecord", path), rows, "path string, record bigint, list bigint, name string, kind string, values array<string>", [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())])


def message_trees(records: DataFrame, most_depth: int = 6) -> DataFrame:
    """``records`` (path, at, content) with every message, without its schema, as a VARIANT ``tree``: field numbers, and a list of values for each."""

    def rows(content: bytes) -> Iterator[tuple]:
        yield (json.dumps(walk(content, most_depth)),)

    return _each_record(records, rows, "path string, at bigint, tree string", [pa.string()]).withColumn("tree", F.parse_json("tree"))


def capped_json(spark: SparkSession, path: str, most_bytes: int) -> DataFrame:
    """JSON values in the first ``most_bytes`` compressed bytes of each file: a sampling scan that reads no more.

    ``share`` is the part of its file that had been read when a value was
    complete.
    """
    share = F.least(F.lit(1.0), F.col("consumed") / F.greatest(F.lit(1), "length"))
    return read(spark, "capped_json", path, cap=most_bytes).select("path", "at", "record", share.alias("share"))


def varint(n: int) -> bytes:
    """A number in base 128; negative ones as 64 bits."""
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def message(parts: Iterable[tuple[int, int | bytes]]) -> bytes:
    """A protobuf message of (field number, number or bytes)."""
    return b"".join(varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v for k, v in parts)


def _coded(values: list) -> bytes:
    if all(isinstance(v, int) for v in values):
        return message([(3, message([(1, b"".join(map(varint, values)))]))])
    if all(isinstance(v, float) for v in values):
        return message([(2, message([(1, np.array(values, "<f4").tobytes())]))])
    return message([(1, message([(1, str(v).encode()) for v in values]))])


def coded_example(context: dict[str, list], lists: dict[str, list[list]]) -> bytes:
    """A SequenceExample."""
    entry = lambda name, body: (1, message([(1, name.encode()), (2, body)]))
    head = message([entry(k, _coded(v)) for k, v in context.items()])
    body = message([entry(k, message([(1, _coded(v)) for v in steps])) for k, steps in lists.items()])
    return message([(1, head), (2, body)])
