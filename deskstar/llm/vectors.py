"""Vectors as the two vector operators take them: whole, finite and not zero, equal ones counted once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Columns ``vec_id, v`` (array of doubles) of the vectors without null or non-finite components that are not zero."""
    v = F.col(embedding).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0.0))


def identity(v: str = "v"):
    """128 bits that equal vectors share (0.0 and -0.0 are equal)."""
    plain = F.transform(v, lambda x: x + F.lit(0.0))
    return F.struct(F.xxhash64(plain).alias("a"), F.xxhash64(F.lit(1), plain).alias("b"))


def stacked(lists: pa.Array) -> list[np.ndarray]:
    """One array per row of a list column."""
    return [np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64) for v in lists]
