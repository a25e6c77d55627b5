"""Mixtures: as many rows of each group as its target share asks for, exactly."""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sampling import hash_uniform

#: Bins of the hash; the rows of one bin of a group are ranked together.
BINS = 1 << 16


def quotas(weights: Mapping[str, float | int | Fraction], total: int) -> dict[str, int]:
    """``total`` by weight: whole parts, and what is left to the largest remainders (of equal ones to the smaller name)."""
    exact = {g: Fraction(w) for g, w in weights.items()}
    if not exact or min(exact.values()) < 0 or not (whole := sum(exact.values())):
        raise ValueError("weights must be positive")
    parts = {g: total * w / whole for g, w in exact.items()}
    out = {g: int(p) for g, p in parts.items()}
    for g in sorted(parts, key=lambda g: (out[g] - parts[g], g))[: total - sum(out.values())]:
        out[g] += 1
    return out


def shares(rows: DataFrame, group: str, weights: Mapping[str, float | int | Fraction]) -> DataFrame:
    """``group``, ``n``, ``physical`` and ``target`` share, and ``factor`` between them, for the groups of ``weights``."""
    whole = sum(Fraction(w) for w in weights.values())
    wanted = rows.sparkSession.createDataFrame([(g, float(Fraction(w) / whole)) for g, w in weights.items()], f"{group} string, target double")
    counts = rows.groupBy(group).agg(F.count("*").alias("n"))
    counted = F.broadcast(wanted).join(counts, group, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = Window.partitionBy(F.lit(0))  # a row for each group of weights
    physical = F.col("n") / F.nullif(F.sum("n").over(total), F.lit(0))
    return counted.select(group, "n", physical.alias("physical"), "target", (F.col("target") / F.nullif(physical, F.lit(0.0))).alias("factor"))


def mixture(rows: DataFrame, key: str, group: str, weights: Mapping[str, float | int | Fraction], total: int, seed: str = "mixture") -> DataFrame:
    """``rows`` so often that each group of ``weights`` has its quota of ``total``, with the number of the ``copy``.

    A group with more rows than its quota is cut, one with fewer is repeated:
    every row as often as the quota holds the stock, and the rows of least hash
    once more.  Which these are is found from counts by hash bin, so that only
    the rows of one bin of each group are ranked, and does not depend on how
    rows are dealt.  ``key`` tells rows apart.  Rows of other groups, and with
    a null group, go; a group with a quota and no rows is an error.
    """
    wanted = quotas(weights, total)
    drawn = rows.filter(F.col(group).isin(list(wanted))).withColumn("_u", hash_uniform(F.col(key), seed)).withColumn("_bin", F.floor(F.col("_u") * BINS).cast("int"))
    counts = drawn.groupBy(group, "_bin").agg(F.count("*").alias("_n"))
    stock = {r[0]: r[1] for r in counts.groupBy(group).agg(F.sum("_n")).collect()}  # a row for each group of weights
    lacking = [g for g, q in wanted.items() if q and not stock.get(g)]
    if lacking:
        raise ValueError(f"no rows of {', '.join(sorted(lacking))}")
    plan = [(g, q // stock[g], q % stock[g]) for g, q in wanted.items() if stock.get(g)]
    plan = rows.sparkSession.createDataFrame(plan, f"{group} string, _times long, _more long")
    before = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS rows a group
    bins = counts.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(F.broadcast(plan), group)
    edge = bins.filter((F.col("_skip") < F.col("_more")) & (F.col("_skip") + F.col("_n") > F.col("_more"))).select(group, "_bin", F.col("_skip").alias("_edge_skip"))
    full = F.broadcast(plan.join(edge.withColumnRenamed("_bin", "_edge"), group, "left"))
    placed = drawn.join(full, group)
    inside = placed.filter(F.col("_bin") == F.col("_edge"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_u", key)) + F.col("_edge_skip")
    inside = inside.withColumn("_often", F.col("_times") + (rank <= F.col("_more")).cast("long"))
    last = bins.filter((F.col("_skip") + F.col("_n") <= F.col("_more"))).groupBy(group).agg(F.max("_bin").alias("_last"))
    outside = placed.filter(F.col("_edge").isNull() | (F.col("_bin") != F.col("_edge"))).join(F.broadcast(last), group, "left")
    outside = outside.withColumn("_often", F.col("_times") + F.coalesce(F.col("_bin") <= F.col("_last"), F.lit(False)).cast("long"))
    columns = [*rows.columns, "_often"]
    often = outside.select(*columns).unionByName(inside.select(*columns)).filter("_often > 0")
    return often.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_often") - 1))).drop("_often")
