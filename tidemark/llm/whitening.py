"""Whitening of embeddings by the covariance of their distinct integer vectors.

The covariance is that of the distinct vectors: each is centred first, exactly
in its whole part and with one rounding for the rest, and MLlib's RowMatrix adds
up the products.  Its size depends on the dimensions alone, so eigenvectors are
found on the driver and the whitening matrix goes to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import materialise
from .vectors import floored, matrix

SCALE, COMPONENTS = 256, 4
#: Floors beyond this count as this.
LIMIT = 1 << 40
#: An eigenvalue below this share of the largest is zero: the vectors do not vary there.
FLAT = 1e-12

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def gramian(rows: DataFrame, vector: Column, n: int, d: int) -> np.ndarray:
    """The sum of each row's products, by MLlib."""
    frame = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(vector).alias("v")), "v")
    return RowMatrix(frame, n, d).computeGramianMatrix().toArray()


def sums(rows: DataFrame, d: int) -> list[int]:
    """The exact sum of every dimension of ``x``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, np.int64)
        for batch in batches:
            total += matrix(batch.column(0), d).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total)], names=["at", "total"])

    parts = rows.select("x").mapInArrow(add, "at long, total long").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["at"]: int(r["total"]) for r in parts.collect()}  # d rows
    return [found[i] for i in range(d)]


def axes(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues that are not zero and their unit vectors, one to a column, each with a positive largest entry."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    many = min(components, int((values > FLAT * max(values[0], 0)).sum()))
    vectors = vectors[:, :many]
    largest = vectors[np.abs(vectors).argmax(0), np.arange(many)]
    return values[:many], vectors * np.where(largest < 0, -1, 1)


def centred(x: np.ndarray, total: list[int], n: int) -> np.ndarray:
    """x less its mean: the mean's whole part is taken off exactly."""
    return (x - np.array([s // n for s in total], np.int64)).astype(np.float64) - np.array([s % n / n for s in total])


def deviations(x: np.ndarray, total: list[int], n: int) -> np.ndarray:
    """Sum over dimensions of (n * x - total) ** 2 as whole numbers; None where it leaves 64 bits."""
    rough = ((n * x.astype(np.float64) - np.array(total, np.float64)) ** 2).sum(1)
    out = np.full(len(x), None, object)
    fits = rough < float(1 << 62)
    own = x[fits] * np.int64(n) - np.array([((s + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63) for s in total], np.int64)
    out[fits] = (own * own).sum(1).tolist()
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Rows of every usable vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null, empty or hold null or non-finite components are
    dropped, and so are those of another length than most.  Each distinct
    integer vector counts once in the fit; repeated rows each give rows, and
    rows with a null id too.  There are fewer components where the vectors vary
    in fewer directions: equal vectors give no rows, and neither does an empty
    table.  ``deviation`` is null where it leaves 64 bits.  Of equal eigenvalues
    any basis may be taken, the same for all rows.  Other columns are not read,
    whatever their names.
    """
    spark = vectors.sparkSession
    reach_workers(spark)
    rows, d = floored(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")), "v", scale, LIMIT)
    if not d:
        return spark.createDataFrame([], SCHEMA)
    rows = materialise(rows, "floors")
    fit = materialise(rows.select("x").distinct(), "fit")
    n = fit.count()
    total = sums(fit, d)
    whole, rest = F.lit([s // n for s in total]), F.lit([s % n / n for s in total])
    middle = F.transform("x", lambda v, i: (v - F.get(whole, i)).cast("double") - F.get(rest, i))
    covariance = gramian(fit, middle, n, d) / n
    values, vectors_ = axes(covariance, components)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)
    basis = vectors_ / np.sqrt(values)
    shared = spark.sparkContext.broadcast(basis)  # d times the number of components
    explained = values / np.trace(covariance)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                yield pd.DataFrame({"w": list(centred(np.stack(part["x"].to_list()).astype(np.int64), total, n) @ shared.value)})

    k = len(values)
    own = gramian(fit.mapInPandas(project, "w array<double>"), F.col("w"), n, k) / n
    error = float(np.abs(own - np.eye(k)).max())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if len(part):
                x = np.stack(part["x"].to_list()).astype(np.int64)
                found = centred(x, total, n) @ shared.value
                yield pd.DataFrame(
                    {
                        "vec_id": part["vec_id"].astype("Int64").repeat(k),
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                        "n": n,
                        "deviation": pd.array(deviations(x, total, n).repeat(k), "Int64"),
                        "whitened": found.ravel(),
                        "explained": np.tile(explained, len(x)),
                        "identity_error": error,
                    }
                )

    return rows.select("vec_id", "x").mapInPandas(run, SCHEMA)
