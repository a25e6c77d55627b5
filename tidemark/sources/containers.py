"""Containers as Spark data sources: files cut into partitions, filters on member names taken along, shards written under a commit.

``register`` makes them known to a session: ``capped_json`` to read; ``tar``,
``zip``, ``tfrecord``, ``npy``, ``lines`` and ``each_file`` to read and to write.
All take the ``path`` of a file or a folder (``load(path)``, ``save(path)``); a
folder is listed with everything below it, but for names that start with ``_``
or ``.``.
"""

from __future__ import annotations

import io
import re
import struct
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import reach_workers
from . import decoding

#: Bytes of a file in one partition, where its format can be cut.
SPLIT_BYTES = 128 << 20
#: A file counts as so many bytes more, so that a partition of small ones stays short; with many files there are so many partitions at least.
OPEN_BYTES, LEAST_PARTS = 64 << 10, 64
#: Bytes looked at together for the start of a framed record.
SEEK_BYTES = 1 << 20
#: Records and bytes that are worked on or handed on together.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20
#: Longer framed records are broken ones.
LONGEST_RECORD = (1 << 31) - 64


def system_of(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def listed(path: str) -> list[tuple[str, int]]:
    """Files and their lengths, in order of name."""
    from pyarrow import fs

    system, name = system_of(path)
    scheme = re.match(r"(\w+://)?", path if "://" in path else "file://")[0]
    info = system.get_file_info(name)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(name, recursive=True))
    hidden = lambda p: any(x[:1] in "_." for x in p[len(name) :].split("/") if x)
    return sorted((scheme + f.path, f.size) for f in found if f.type == fs.FileType.File and not hidden(f.path))


def opened(path: str) -> BinaryIO:
    system, name = system_of(path)
    return system.open_input_file(name)


@dataclass
class Part(InputPartition):
    """Bytes, members or rows ``start`` to ``end`` of a file."""

    path: str
    length: int
    start: int = 0
    end: int = 0


@dataclass
class Parts(InputPartition):
    """Small parts that one task reads one after another."""

    parts: list[Part]


class _Files(DataSourceReader):
    """Parts of files, small ones together in a partition; ``cut`` gives the parts of a file, ``rows`` reads one."""

    #: Columns whose filters are taken along.
    pushed_column: str | None = None

    def __init__(self, options: dict[str, str], columns: str = ""):
        self.options = options
        kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        self.columns = pa.schema([(name, kinds.get(kind)) for name, kind in (c.split() for c in columns.split(", ") if c)]) if "<" not in columns else pa.schema([])
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on the member's name are answered here, so that other members are not unpacked."""
        kinds = {EqualTo: "is", In: "in", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "holds"}
        for f in filters:
            if type(f) in kinds and f.attribute == (self.pushed_column,):
                self.tests.append((kinds[type(f)], f.value))
            else:
                yield f

    def wanted(self, name: str) -> bool:
        answers = {"is": lambda v: name == v, "in": lambda v: name in v, "starts": lambda v: name.startswith(v), "ends": lambda v: name.endswith(v), "holds": lambda v: v in name}
        return all(answers[kind](value) for kind, value in self.tests)

    def partitions(self) -> list[Parts]:
        """Whole small files are put together, as a task for each costs more than to read them."""
        files = listed(self.options["path"])
        cost = lambda length: length + OPEN_BYTES
        most = min(self.split, -(-sum(cost(length) for _, length in files) // LEAST_PARTS))
        out, held = [Parts([])], 0
        for path, length in files:
            parts = list(self.cut(path, length))
            if len(parts) > 1:
                out += [Parts([p]) for p in parts]
                held = most
                continue
            if not out[-1].parts or held + cost(length) <= most:
                held += cost(length)
            else:
                out.append(Parts([]))
                held = cost(length)
            out[-1].parts += parts
        return out

    def cut(self, path: str, length: int) -> Iterator[Part]:
        yield Part(path, length)

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        rows = (row for part in partition.parts for row in self.rows(part))
        for some in _together(rows, lambda row: sum(len(x) for x in row if isinstance(x, bytes | str))):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), self.columns.types, strict=True)], schema=self.columns)

    def rows(self, part: Part) -> Iterator:
        raise NotImplementedError


class _CappedJson(_Files):
    def rows(self, part: Part) -> Iterator[tuple]:
        cap = int(self.options["cap"]) if "cap" in self.options else None
        read = 0

        def pieces(stream: BinaryIO) -> Iterator[bytes]:
            nonlocal read
            for piece, read in decoding.inflated(stream, cap):  # noqa: B007
                yield piece

        with opened(part.path) as stream:
            for n, record in enumerate(decoding.json_values(pieces(stream), whole=cap is None or cap >= part.length)):
                yield part.path, n, record, read, part.length


class _Salvaged(_Files):
    """Lines of text files; of a gzip file that breaks off or is broken, those that could be unpacked whole."""

    def rows(self, part: Part) -> Iterator[tuple]:
        with opened(part.path) as stream:
            end = decoding.Ending()
            pieces = (piece for piece, _ in decoding.inflated(stream, end=end))
            for n, line in enumerate(decoding.whole_lines(pieces, end)):
                yield part.path, n, line


def tar_entries(stream: BinaryIO, wanted: Callable[[str], bool], depth: int = 1) -> Iterator[tuple[str, bytes]]:
    """Members of a tar, packed or not, and of tars inside it, ``depth`` levels down; only wanted ones are read."""
    with tarfile.open(fileobj=stream, mode="r|*") as tar:
        for m in tar:
            tar.members.clear()  # else every header stays in memory
            if not m.isfile():
                continue
            if m.name.endswith((".tar", ".tar.gz", ".tgz")) and depth:
                yield from ((f"{m.name}!{n}", d) for n, d in tar_entries(tar.extractfile(m), lambda n, m=m: wanted(f"{m.name}!{n}"), depth - 1))
            elif wanted(m.name):
                yield m.name, tar.extractfile(m).read()


class _Tar(_Files):
    pushed_column = "member"

    def rows(self, part: Part) -> Iterator[tuple]:
        with opened(part.path) as stream:
            for name, content in tar_entries(stream, self.wanted):
                yield part.path, name, content


class _Whole(_Files):
    """Files as they are."""

    pushed_column = "member"

    def rows(self, part: Part) -> Iterator[tuple]:
        name = part.path.rpartition("/")[2]
        if self.wanted(name):
            with opened(part.path) as stream:
                yield part.path, name, stream.read()


class _Zip(_Files):
    """The directory at a file's end says where its members lie, so ranges of members make partitions."""

    pushed_column = "member"

    def cut(self, path: str, length: int) -> Iterator[Part]:
        if length <= self.split:
            yield Part(path, length, 0, -1)
            return
        with opened(path) as stream, zipfile.ZipFile(stream) as z:
            first, held = 0, 0
            infos = z.infolist()
            for k, info in enumerate(infos):
                held += info.compress_size
                if held >= self.split or k == len(infos) - 1:
                    yield Part(path, length, first, k + 1)
                    first, held = k + 1, 0

    def rows(self, part: Part) -> Iterator[tuple]:
        with opened(part.path) as stream, zipfile.ZipFile(stream) as z:
            infos = z.infolist()
            for info in infos[part.start : len(infos) if part.end < 0 else part.end]:
                if not info.is_dir() and self.wanted(info.filename):
                    yield part.path, info.filename, z.read(info)


class _TFRecord(_Files):
    """Plain files are cut by bytes; a task finds its first record by the checksum of the length before it.

    A partition has the records that start in its range.  With the option
    ``verify`` a body whose checksum is wrong is an error.
    """

    def cut(self, path: str, length: int) -> Iterator[Part]:
        with opened(path) as stream:
            packed = stream.read(2) == b"\x1f\x8b"
        step = max(length, 1) if packed else self.split
        for start in range(0, max(length, 1), step):
            yield Part(path, length, start, min(length, start + step))

    def rows(self, part: Part) -> Iterator[tuple]:
        with opened(part.path) as stream:
            if stream.read(2) == b"\x1f\x8b":
                stream.seek(0)
                yield from self._checked(part.path, self._frames(_Joined(decoding.inflated(stream)), 0, None))
                return
            start = self._first(stream, part) if part.start else 0
            if start is not None:
                stream.seek(start)
                yield from self._checked(part.path, self._frames(stream, start, part.end))

    def _first(self, stream: BinaryIO, part: Part) -> int | None:
        at = part.start
        while at < part.end:
            stream.seek(at)
            block = stream.read(SEEK_BYTES + 11)
            for k in decoding.frame_starts(block).tolist():
                (n,) = struct.unpack_from("<Q", block, k)
                if at + k >= part.end:
                    return None
                if at + k + 16 + n <= part.length and self._leads(stream, at + k + 16 + n, part):
                    return at + k
            at += SEEK_BYTES
        return None

    @staticmethod
    def _leads(stream: BinaryIO, at: int, part: Part) -> bool:
        """Whether records follow one another from ``at`` past the end of ``part``, so that only a record that holds records and fills a whole partition is taken for several."""
        heads = io.BufferedReader(stream, 1 << 20)
        try:
            while at < part.end:
                heads.seek(at)
                head = heads.read(12)
                if len(head) < 12 or not len(decoding.frame_starts(head)):
                    return False
                at += 16 + struct.unpack("<Q", head[:8])[0]
            if at < part.length:
                heads.seek(at)
                return bool(len(decoding.frame_starts(heads.read(12))))
            return at == part.length
        finally:
            heads.detach()

    @staticmethod
    def _frames(stream: BinaryIO, at: int, end: int | None) -> Iterator[tuple[int, bytes, int]]:
        while (end is None or at < end) and len(head := stream.read(12)) == 12:
            (n,) = struct.unpack("<Q", head[:8])
            if n > LONGEST_RECORD or len(body := stream.read(n + 4)) < n + 4:
                return
            yield at, body[:n], int.from_bytes(body[n:], "little")
            at += 16 + n

    def _checked(self, path: str, frames: Iterator[tuple[int, bytes, int]]) -> Iterator[tuple]:
        if self.options.get("verify", "false").lower() != "true":
            yield from ((path, at, body) for at, body, _ in frames)
            return
        for some in _together(frames, lambda frame: len(frame[1])):
            wrong = np.flatnonzero(decoding.masked_checksums([body for _, body, _ in some]) != np.array([stored for *_, stored in some], np.uint32))
            for at, body, _ in some[: wrong[0]] if len(wrong) else some:
                yield path, at, body
            if len(wrong):
                raise ValueError(f"{path}: the record at {some[wrong[0]][0]} does not have its checksum")


def _together[T](items: Iterator[T], size: Callable[[T], int]) -> Iterator[list[T]]:
    """Items in lists of BATCH_ROWS, or of about BATCH_BYTES."""
    some, held = [], 0
    for item in items:
        some.append(item)
        held += size(item)
        if len(some) >= BATCH_ROWS or held >= BATCH_BYTES:
            yield some
            some, held = [], 0
    if some:
        yield some


class _Joined(io.RawIOBase):
    """Pieces as a stream."""

    def __init__(self, pieces: Iterator[tuple[bytes, int]]):
        self.pieces, self.rest = pieces, b""

    def read(self, n: int = -1) -> bytes:
        got = [self.rest]
        have = len(self.rest)
        while have < n and (piece := next(self.pieces, None)):
            got.append(piece[0])
            have += len(piece[0])
        whole = b"".join(got)
        self.rest = whole[n:]
        return whole[:n]


class _Npy(_Files):
    """Arrays by rows; a partition reads the bytes of its rows, where rows lie one after another."""

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        for part in partition.parts:
            yield from self.rows(part)

    def cut(self, path: str, length: int) -> Iterator[Part]:
        if not path.endswith(".npy"):
            return
        with opened(path) as stream:
            shape, _, kind, _ = npy_header(stream)
        rows, row = shape[0] if shape else 1, max(1, int(np.prod(shape[1:], dtype=np.int64)) * kind.itemsize)
        step = max(1, self.split // row)
        for start in range(0, rows, step):
            yield Part(path, length, start, min(rows, start + step))

    def rows(self, part: Part) -> Iterator[pa.RecordBatch]:
        with opened(part.path) as stream:
            shape, by_column, kind, head = npy_header(stream)
            width = int(np.prod(shape[1:], dtype=np.int64))
            if by_column:
                stream.seek(0)
                whole = np.load(io.BytesIO(stream.read())).reshape(-1, width)
            for at in range(part.start, part.end, step := max(1, (1 << 22) // max(1, width * kind.itemsize))):
                many = min(step, part.end - at)
                if by_column:
                    cells = whole[at : at + many]
                else:
                    stream.seek(head + at * width * kind.itemsize)
                    cells = np.frombuffer(stream.read(many * width * kind.itemsize), kind)
                values = pa.ListArray.from_arrays(pa.array(np.arange(many + 1, dtype=np.int32) * width), pa.array(cells.astype(np.float64).ravel()))
                columns = [pa.array([part.path] * many), pa.array(np.arange(at, at + many)), pa.array([list(shape)] * many, pa.list_(pa.int64())), values]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "row", "shape", "values"])


def npy_header(stream: BinaryIO) -> tuple[tuple[int, ...], bool, np.dtype, int]:
    """Shape, whether columns lie together, element type and where the elements start."""
    version = np.lib.format.read_magic(stream)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, by_column, kind = read(stream)
    return shape, by_column, kind, stream.tell()


@dataclass
class Written(WriterCommitMessage):
    """A partition's shards under their temporary names, and its number."""

    temporary: list[str]
    partition: int


class _Shards(DataSourceArrowWriter):
    """One shard per task that has rows, written under a temporary name and moved to ``part-N`` when all tasks are done.

    N is the number of the task's partition; where shards are added to a folder
    the job's mark follows it.  With the option ``shard_bytes`` a shard ends
    when its rows hold so many bytes, and the next one of the task has a
    further number in its name.
    """

    suffix = ""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.suffix = options.get("suffix", self.suffix)
        self.most = int(options["shard_bytes"]) if "shard_bytes" in options else None

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        rows = self._rows(batches)
        system, folder = system_of(self.path)
        names: list[str] = []
        while (first := next(rows, None)) is not None:
            system.create_dir(f"{folder}/_temporary-{self.job}")
            name = f"{folder}/_temporary-{self.job}/{uuid.uuid4().hex}"
            with system.open_output_stream(name, compression=None) as out:
                self.fill(out, self._shard(first, rows), lambda mode, name=name: system.open_output_stream(f"{name}.cells") if mode == "w" else system.open_input_stream(f"{name}.cells"))
            names.append(name)
        return Written(names, TaskContext.get().partitionId())

    def _rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches that have rows, cut so that little is held in Python at once."""
        for batch in batches:
            many = max(1, min(BATCH_ROWS, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, many):
                yield batch.slice(at, many)

    def _shard(self, first: pa.RecordBatch, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = first.nbytes
        yield first
        while (self.most is None or held < self.most) and (batch := next(rows, None)) is not None:
            held += batch.nbytes
            yield batch

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        """Write a shard; ``scratch`` opens a file beside it, to write or to read."""
        raise NotImplementedError

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, folder = system_of(self.path)
        system.create_dir(folder)
        if self.overwrite:
            for f in system.get_file_info(fs.FileSelector(folder)):
                if f.type == fs.FileType.File:
                    system.delete_file(f.path)
        mark = "" if self.overwrite else f"-{self.job[:8]}"
        for m in (m for m in messages if m):
            for k, name in enumerate(m.temporary):
                system.move(name, f"{folder}/part-{m.partition:05d}{mark}{f'-{k:04d}' if k else ''}{self.suffix}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, folder = system_of(self.path)
        left = f"{folder}/_temporary-{self.job}"
        if system.get_file_info(left).type == fs.FileType.Directory:
            system.delete_dir(left)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for name, content in zip(batch.column("member").to_pylist(), batch.column("content"), strict=True):
            yield name, content.as_py() or b""


class _TarShards(_Shards):
    suffix = ".tar"

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        with tarfile.open(fileobj=out, mode="w|gz" if self.suffix.endswith("gz") else "w|") as tar:
            for name, content in _members(batches):
                info = tarfile.TarInfo(name)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))


class _ZipShards(_Shards):
    suffix = ".zip"

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        with zipfile.ZipFile(_Unseekable(out), "w", zipfile.ZIP_DEFLATED) as z:
            for name, content in _members(batches):
                z.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED)


class _Unseekable(io.RawIOBase):
    """An output that zipfile only appends to."""

    def __init__(self, out: BinaryIO):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        self.out.flush()


class _TFRecordShards(_Shards):
    suffix = ".tfrecord"

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        for batch in batches:
            for frame in decoding.framed([x.as_py() or b"" for x in batch.column("content")]):
                out.write(frame)


class _NpyShards(_Shards):
    """Rows of equal length as one array: the elements go to a file of their own first, as the header says how many there are."""

    suffix = ".npy"

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        rows, width = 0, None
        with scratch("w") as cells:
            for batch in batches:
                sizes = set(batch.column("values").value_lengths().to_pylist())
                if len(sizes | ({width} if width is not None else set())) > 1:
                    raise ValueError("rows of an array have one length")
                width = sizes.pop()
                rows += batch.num_rows
                cells.write(batch.column("values").flatten().to_numpy(zero_copy_only=False).astype("<f4").tobytes())
        head = io.BytesIO()
        np.lib.format.write_array_header_1_0(head, {"descr": "<f4", "fortran_order": False, "shape": (rows, width)})
        out.write(head.getvalue())
        with scratch("r") as cells:
            while block := cells.read(1 << 20):
                out.write(block)


class _Lines(_Shards):
    """Rows of ``value`` as lines, gzip if the suffix says so."""

    suffix = ".jsonl"

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        pack = zlib.compressobj(wbits=zlib.MAX_WBITS | 16) if self.suffix.endswith(".gz") else None
        for batch in batches:
            text = "".join(f"{v}\n" for v in batch.column("value").to_pylist() if v is not None).encode()
            out.write(pack.compress(text) if pack else text)
        if pack:
            out.write(pack.flush())


class _Each(_Shards):
    """Every row as a file of its own, ``member`` with ``content``; all appear when all tasks are done."""

    def fill(self, out: BinaryIO, batches: Iterator[pa.RecordBatch], scratch: Callable[[str], BinaryIO]) -> None:
        system, folder = system_of(self.path)
        for name, content in _members(batches):
            inner = f"{folder}/_temporary-{self.job}/{uuid.uuid4().hex}.content"
            with system.open_output_stream(inner, compression=None) as f:
                f.write(content)
            out.write(f"{inner}\t{name}\n".encode())

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = system_of(self.path)
        made: set[str] = set()
        for listing in (name for m in messages if m for name in m.temporary):
            with system.open_input_stream(listing) as f:
                for line in f.read().decode().splitlines():
                    inner, name = line.split("\t")
                    target = f"{folder}/{name}"
                    if (inside := target.rpartition("/")[0]) not in made:
                        system.create_dir(inside)
                        made.add(inside)
                    system.move(inner, target)
        self.abort(messages)


def _source(kind: str, columns: str, reads: type[_Files], writes: type[_Shards] | None = None) -> type[DataSource]:
    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return kind

        def schema(self) -> str:
            return columns

        def reader(self, schema: StructType) -> DataSourceReader:
            return reads(dict(self.options), columns)

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
            if writes is None:
                raise NotImplementedError(f"{kind} is not written")
            return writes(dict(self.options), overwrite)

    Source.__name__ = Source.__qualname__ = f"Source_{kind}"
    return Source


SOURCES = [
    _source("capped_json", "path string, at bigint, record string, consumed bigint, length bigint", _CappedJson),
    _source("tar", "path string, member string, content binary", _Tar, _TarShards),
    _source("zip", "path string, member string, content binary", _Zip, _ZipShards),
    _source("tfrecord", "path string, at bigint, content binary", _TFRecord, _TFRecordShards),
    _source("lines", "path string, line bigint, value string", _Salvaged, _Lines),
    _source("each_file", "path string, member string, content binary", _Whole, _Each),
    _source("npy", "path string, row bigint, shape array<bigint>, values array<double>", _Npy, _NpyShards),
]


def register(spark: SparkSession) -> None:
    """Make the sources known to ``spark``, with filters handed to them."""
    reach_workers(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in SOURCES:
        spark.dataSource.register(source)
