"""Dense numbers without a task that sees all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def number_rows(rows: DataFrame, order: list[str], name: str, by: list[str] | None = None, first: int = 0, parts: int | None = None) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2, ... (from ``first``) in ``order``, within each key of ``by`` if given.

    Two passes: rows are dealt by ranges of (key, order), sorted and written
    with their range and their place in it; the counts of each range, and what
    came before, are a small table.  So a key with most of the rows is cut into
    ranges like any other.  Rows that agree on key and order are numbered in
    any order.
    """
    by = by or []
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *by, *order).sortWithinPartitions(*by, *order)
    place = F.monotonically_increasing_id()
    ranged = written(ranged.withColumns({"_range": F.shiftright(place, 33), "_place": place.bitwiseAND((1 << 33) - 1)}), "ranged")
    keys = ["_range", *by]
    counts = ranged.groupBy(*keys).agg(F.min("_place").alias("_least"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by or [F.lit(0)]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range and key that meet
    starts = counts.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least") + first)
    starts = starts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_skip")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return ranged.join(starts, same).select(*rows.columns, (F.col("_place") + F.col("_skip")).alias(name))
