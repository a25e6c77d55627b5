"""Deterministic randomness: the same key always draws the same number, on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 32 bits of the md5 of the parts joined by ``|``."""
    key = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def keep_at_rate(rate: float, *parts: Column | str) -> Column:
    """Dropout: true with probability 1 - rate; a rate of 1 drops all."""
    return F.lit(False) if rate >= 1 else hash_uniform(*parts) > F.lit(float(rate))
