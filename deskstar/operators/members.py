"""Dimension members: distinct values, missing members, enrichment of blank attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar import schemas, vocab
from deskstar.functions.temporal import calendar_attributes, to_day
from deskstar.functions.text import blank_to_default, normalise_text
from deskstar.operators.joins import anti_new_members, small
from deskstar.operators.keys import assign_surrogate_keys, next_key
from deskstar.sources.warehouse import Warehouse


def written_values(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Each value once, as it is written, so that the text work on it is done once and not for every row.

    A plain ``distinct`` here is dropped by the optimizer where another one follows; the count keeps it in the plan.
    """
    return df.select(value.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0").select(name)


def distinct_members(
    df: DataFrame, source: str, name: str, default: str | None = None, casefold: bool = False
) -> DataFrame:
    """Distinct trimmed names. Blanks are dropped, or become ``default`` if one is given."""
    value = blank_to_default(F.col(name), default)
    if casefold:
        value = F.lower(value)
    written = written_values(df, F.col(source), name)
    return written.select(value.alias(name)).where(F.col(name).isNotNull()).distinct()


def union_dates(df: DataFrame, cols: Sequence[str], name: str = "data_completa") -> DataFrame:
    """Distinct days out of several date columns; unparsable values are dropped."""
    written = written_values(df, F.explode(F.array(*[F.col(c).cast("string") for c in cols])), name)
    return written.select(to_day(F.col(name)).alias(name)).where(F.col(name).isNotNull()).distinct()


def missing_members(
    existing: DataFrame, candidates: DataFrame, table: str, casefold: bool = False
) -> DataFrame:
    """Candidates whose natural key is not stored; ``casefold`` compares in lower case."""
    _, nk = schemas.DIMENSION_KEYS[table]
    known = existing.select(F.lower(F.col(nk)).alias(nk)) if casefold else existing
    return anti_new_members(candidates, known, [nk])


def insert_missing_members(
    warehouse: Warehouse, candidates: DataFrame, table: str, casefold: bool = False
) -> DataFrame:
    """Append the candidates that are new, with keys after the last one, and return the dimension.

    Existing rows never change. The new members are stored before they are numbered, so the
    candidates, which may come out of a whole fact, are computed once. Where none is new, nothing is written.
    """
    sk, nk = schemas.DIMENSION_KEYS[table]
    existing = warehouse.read(table)
    new = missing_members(existing, candidates, table, casefold)
    if sk not in new.columns:
        stored = warehouse.stage(new, table)
        if warehouse.exists(table) and stored.isEmpty():
            return existing
        new = assign_surrogate_keys(stored, nk, sk, next_key(existing, sk))
    warehouse.append(new, table)
    return warehouse.read(table)


def time_members(days: DataFrame) -> DataFrame:
    return calendar_attributes(days)


def coalesce_enrich(
    dim: DataFrame, updates: DataFrame, key: str, cols: Sequence[str]
) -> DataFrame:
    """Fill only the blank attributes of existing rows; filled ones stay.

    ``updates`` has one row per key.
    """
    fresh = updates.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in cols]
    )
    side = F.broadcast(fresh) if small(fresh) else fresh
    joined = dim.join(side, F.col(key) == F.col("_key"), "left")

    def value(name: str) -> Column:
        if name not in cols:
            return F.col(name)
        return F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(f"_new_{name}")).alias(name)

    return joined.select(*[value(c) for c in dim.columns])


def filter_nonblank_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(normalise_text(F.col(k)) != "")
    return df


def seed_members(spark: SparkSession, table: str) -> DataFrame:
    """The fixed members of a domain dimension."""
    _, nk = schemas.DIMENSION_KEYS[table]
    names = F.array(*[F.lit(name) for name in vocab.SEED_MEMBERS[table]])
    return spark.range(1, numPartitions=1).select(F.explode(names).alias(nk))
