"""Surrogate keys that are dense, unique and the same on every execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_key(existing: DataFrame, sk: str) -> Column:
    """Largest key in use, as a scalar subquery; 0 for an empty table."""
    return existing.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint")).scalar()


def assign_surrogate_keys(
    new: DataFrame, nk: str | Sequence[str], sk: str, start: Column | None = None, buckets: int = 64
) -> DataFrame:
    """Number the rows of ``new``, whose natural key ``nk`` is unique and not NULL.

    Rows are numbered inside hash buckets and shifted by the size of the buckets before theirs, so
    no task ever sees all rows. The number depends on the data and ``buckets`` only: a recomputed
    task yields the same keys. Give facts more buckets than dimensions. ``new`` is read twice, so
    pass stored rows where computing them is dear.
    """
    nk = [nk] if isinstance(nk, str) else list(nk)
    numbered = new.withColumn("_b", F.pmod(F.xxhash64(*nk), F.lit(buckets)).cast("int"))
    # At most ``buckets`` rows: one task for the running sum, and a bounded broadcast.
    sizes = numbered.groupBy("_b").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_b").orderBy(*nk))
    base = F.lit(0).cast("bigint") if start is None else start
    return (
        numbered.withColumn("_r", within)
        .join(F.broadcast(offsets), "_b")
        .withColumn(sk, (base + F.col("_offset") + F.col("_r")).cast("bigint"))
        .drop("_b", "_r", "_offset")
    )
