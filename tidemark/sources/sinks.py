"""Sinks.  Spark's commit protocol makes each write all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import size_shards
from ..operators.numbering import number_rows
from ..session import written


def write_jsonl(df: DataFrame, path: str, shards: int | None = None, compress: bool = True, by: str | None = None) -> None:
    """JSON lines, in ``shards`` files or one folder per value of ``by``."""
    out = (df.repartition(shards) if shards else df).write.option("compression", "gzip" if compress else "none")
    (out.partitionBy(by) if by else out).json(path)


def write_per_rank(df: DataFrame, path: str, name: str = "file_name") -> None:
    """JSON lines in one folder ``rank=N`` for each input file, N from ``_rank_N`` in its name; files without one go to -1."""
    rank = F.coalesce(F.regexp_extract(F.col(name), r"_rank_(\d+)", 1).try_cast("int"), F.lit(-1))
    df.withColumn("rank", rank).repartition("rank").write.partitionBy("rank").option("compression", "gzip").json(path)


def write_jsonl_if_any(df: DataFrame, path: str) -> bool:
    """JSON lines that appear at once when all are written; nothing at all where there are no rows, and then False."""
    rows = written(df, "rows")
    if rows.isEmpty():
        return False
    rows.write.option("compression", "gzip").json(path)
    return True


def write_row_shards(df: DataFrame, path: str, order: str, rows: int = 5000) -> None:
    """JSON lines in one folder ``shard=N`` for every ``rows`` rows in ``order``; the last one may have fewer."""
    numbered = number_rows(df, [order], "_n").withColumn("shard", F.floor(F.col("_n") / rows)).drop("_n")
    _by_range(numbered, order).json(path)


def _by_range(sharded: DataFrame, order: str) -> DataFrameWriter:
    """Shards in order over tasks of about equal size: a task may write several, and several tasks one."""
    return sharded.repartitionByRange("shard", order).sortWithinPartitions("shard", order).write.partitionBy("shard").option("compression", "gzip")


def write_parquet_shards(df: DataFrame, path: str, shards: int) -> None:
    """zstd parquet in ``shards`` files."""
    df.repartition(shards).write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").parquet(path)


def shard_name(prefix: str, index: int, total: int) -> str:
    return f"{prefix}-{index:05d}-of-{total:05d}.jsonl.gz"


def write_named_shards(df: DataFrame, path: str, prefix: str, total: int, order: str) -> None:
    """``total`` gzip JSON-line files named ``shard_name(prefix, i, total)``, rows dealt by hash of ``order``.

    Spark writes one folder per shard; a finishing step on the driver, which
    sees names only, moves each folder's one file to its name.
    """
    spark = df.sparkSession
    dealt = df.withColumn("_shard", F.pmod(F.xxhash64(order), F.lit(total))).repartition(total, "_shard").sortWithinPartitions("_shard", order)
    dealt.write.partitionBy("_shard").option("compression", "gzip").json(f"{path}/_parts")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for i in range(total):
        here = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_parts/_shard={i}")
        found = [f.getPath() for f in system.listStatus(here)] if system.exists(here) else []
        for part in found:
            system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{shard_name(prefix, i, total)}"))
    system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_parts"), True)


def write_size_shards(df: DataFrame, path: str, order: str, size: str, limit: int) -> None:
    """JSON lines in one folder ``shard=N`` for every ``limit`` of running ``size`` in ``order``, sorted inside."""
    _by_range(size_shards(df, order, size, limit), order).json(path)


def check_shards(spark: SparkSession, path: str, expected: int) -> None:
    """Raise unless ``path`` holds ``expected`` data files."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").distinct().count()
    if found != expected:
        raise ValueError(f"{path}: {found} of {expected} shards")


def replace_columns(df: DataFrame, lookup: DataFrame, key: str, fallback: dict[str, object]) -> DataFrame:
    """Columns of ``lookup`` joined on, with a fallback where a key or value is missing."""
    columns = [c for c in lookup.columns if c != key]
    out = df.drop(*columns).join(lookup, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(fallback.get(c))) for c in columns})
