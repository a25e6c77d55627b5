"""Closed vocabularies: families of numbered tokens, ids by position."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbering import number_rows


def vocabulary(spark: SparkSession, families: tuple[tuple[str, int], ...], first_id: int = 0) -> DataFrame:
    """``token``, ``id`` for ``<family_0>`` ... of every family in turn; ids need no sort, as sizes are known."""
    starts = [first_id, *accumulate((n for _, n in families), initial=first_id)][1:]
    parts = [spark.range(n).select(F.concat(F.lit(f"<{name}_"), "id", F.lit(">")).alias("token"), (F.col("id") + at).alias("id")) for (name, n), at in zip(families, starts, strict=False)]
    return reduce(DataFrame.unionByName, parts)


def append_missing(base: DataFrame, more: DataFrame) -> DataFrame:
    """``base`` and those tokens of ``more`` (``token``, ``ord``) it lacks, in order of ``ord``, with the next ids."""
    top = base.agg(F.max("id")).first()[0]
    fresh = more.join(base, "token", "left_anti").groupBy("token").agg(F.min("ord").alias("ord"))
    numbered = number_rows(fresh, ["ord", "token"], "id", first=0 if top is None else top + 1)
    return base.select("token", "id").unionByName(numbered.select("token", F.col("id").cast("bigint").alias("id")))


def padded_size(n: int, multiple: int = 128) -> int:
    return -(-n // multiple) * multiple
