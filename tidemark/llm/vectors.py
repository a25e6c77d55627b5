"""Vectors as rows of integers, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Vectors with components, none of them null, NaN or infinite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def floored(vectors: DataFrame, vector_col: str, scale: int, limit: int, kind: str = "long") -> tuple[DataFrame, int]:
    """``vectors`` with ``x``, the floors of ``scale`` times each component, as an array of ``kind``, instead of ``vector_col``; and its length.

    Rows whose vector is not ``finite`` go, and so do vectors of another length
    than most (of equally many lengths the shortest counts).  Floors beyond
    ``limit`` either way count as the limit.  A length of 0 means that no row
    is left.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.withColumn(vector_col, v).filter(finite(F.col(vector_col)))
    sizes = rows.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0].d if sizes else 0
    bound = lambda c: F.greatest(F.lit(-float(limit)), F.least(F.lit(float(limit)), F.floor(c * float(scale)).cast("double")))
    rows = rows.filter(F.size(vector_col) == d)
    return rows.withColumn("x", F.transform(vector_col, lambda c: bound(c).cast(kind))).drop(vector_col), d


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A column of lists of ``d`` numbers as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)
