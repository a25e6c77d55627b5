"""A stream sink with a manifest: shards count only once the epoch that wrote them is in it.

Each task writes its rows to a file of its own under a temporary name.  When
all tasks of an epoch are done, the files get their names, each a done marker,
and the epoch one manifest file with a line for every shard, which appears at
once.  An epoch that is run again, because the query ended before its
checkpoint knew of the commit, finds its manifest file and leaves nothing
behind; one that ended before the manifest is written anew under the same
names.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..session import reach_workers
from ..sources.containers import system_of

MANIFEST, DONE, TEMPORARY = "_manifest", "_done", "_temporary"


@dataclass
class Shard(WriterCommitMessage):
    """A shard under its temporary name."""

    temporary: str
    partition: int
    rows: int
    size: int


class _Epochs(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Shard | None:
        system, folder = system_of(self.path)
        system.create_dir(f"{folder}/{TEMPORARY}")
        name, rows, size = f"{folder}/{TEMPORARY}/{uuid.uuid4().hex}", 0, 0
        pack = zlib.compressobj(wbits=zlib.MAX_WBITS | 16)
        with system.open_output_stream(name, compression=None) as out:
            for batch in batches:
                text = "".join(json.dumps(r, default=str) + "\n" for r in batch.to_pylist())
                rows, size = rows + batch.num_rows, size + len(text)
                out.write(pack.compress(text.encode()))
            out.write(pack.flush())
        if not rows:
            system.delete_file(name)
            return None
        return Shard(name, TaskContext.get().partitionId(), rows, size)

    def commit(self, messages: list[Shard | None], batchId: int) -> None:
        system, folder = system_of(self.path)
        manifest = f"{folder}/{MANIFEST}/epoch-{batchId:09d}.jsonl"
        if _exists(system, manifest):
            self.abort(messages, batchId)
            return
        lines = []
        for folder_ in (MANIFEST, DONE):
            system.create_dir(f"{folder}/{folder_}")
        for m in (m for m in messages if m):
            shard = f"shard-{batchId:09d}-{m.partition:05d}.jsonl.gz"
            if _exists(system, f"{folder}/{shard}"):  # of an attempt that ended before its manifest
                system.delete_file(f"{folder}/{shard}")
            system.move(m.temporary, f"{folder}/{shard}")
            with system.open_output_stream(f"{folder}/{DONE}/{shard}.done", compression=None) as out:
                out.write(b"")
            lines.append(json.dumps({"epoch": batchId, "shard": shard, "rows": m.rows, "chars": m.size}) + "\n")
        with system.open_output_stream(f"{manifest}.tmp", compression=None) as out:
            out.write("".join(lines).encode())
        system.move(f"{manifest}.tmp", manifest)

    def abort(self, messages: list[Shard | None], batchId: int) -> None:
        system, _ = system_of(self.path)
        for m in (m for m in messages if m):
            if _exists(system, m.temporary):
                system.delete_file(m.temporary)


def _exists(system, name: str) -> bool:
    from pyarrow import fs

    return system.get_file_info(name).type == fs.FileType.File


class ManifestShards(DataSource):
    """``writeStream.format("manifest_shards")`` with the ``path`` of a folder."""

    @classmethod
    def name(cls) -> str:
        return "manifest_shards"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _Epochs(self.options["path"])


def run_to_manifest(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that is there into shards under ``path`` and stop; a rerun takes only what is new."""
    spark = stream.sparkSession
    reach_workers(spark)
    spark.dataSource.register(ManifestShards)
    stream.writeStream.format("manifest_shards").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``epoch``, ``shard``, ``rows``, ``chars`` of every shard that counts."""
    return spark.read.schema("epoch bigint, shard string, rows bigint, chars bigint").option("pathGlobFilter", "epoch-*.jsonl").json(f"{path}/{MANIFEST}")


def read_shards(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all shards that the manifest names, with their ``shard``."""
    rows = spark.read.schema(schema).option("pathGlobFilter", "shard-*.jsonl.gz").json(path).withColumn("shard", F.col("_metadata.file_name"))
    return rows.join(read_manifest(spark, path).select("shard"), "shard", "left_semi")
