"""Idempotent writes on Parquet tables: by key, by period, by calendar month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar import schemas
from deskstar.operators.joins import broadcast_few
from deskstar.operators.keys import assign_surrogate_keys
from deskstar.sources.warehouse import Warehouse


def _periods(df: DataFrame, name: str) -> set[int | None]:
    """Distinct partition values; calendar periods, so a short list. NULL is a period of its own."""
    return {r[0] for r in df.select(name).distinct().collect()}


def _within(name: str, periods: set[int | None]) -> Column:
    """Whether a row lies in one of the periods."""
    inside = F.col(name).isin(sorted(p for p in periods if p is not None))
    return F.col(name).isNull() | inside if None in periods else F.col(name).isNotNull() & inside


def _keyed(
    warehouse: Warehouse, table: str, batch: DataFrame, known: DataFrame, grain: Sequence[str], sk: str, buckets: int
) -> tuple[DataFrame, int]:
    """The batch with surrogate keys, and the last key in use then.

    Rows stored before keep theirs, so a load that runs again gives the same keys. The others follow the last key of the
    table, which the switch of the load records together with its rows: keys of a load that dies before were never seen.
    """
    kept = broadcast_few(known.groupBy(*grain).agg(F.min(sk).alias(sk)))
    old = batch.drop(sk).join(kept, list(grain)).select(*batch.columns)
    new = warehouse.stage(batch.drop(sk).join(kept, list(grain), "left_anti"), f"{table}-new")
    last = warehouse.last_key(table, sk)
    numbered = assign_surrogate_keys(new, grain, sk, F.lit(last), buckets).select(*batch.columns)
    return old.unionByName(numbered), last + new.count()


def _holding(warehouse: Warehouse, table: str, keys: DataFrame, key: str) -> DataFrame:
    """The stored rows of the months that may hold one of the keys."""
    if schemas.SUMMARISED.get(table) != key:
        return warehouse.physical(table)
    months = warehouse.months_holding(table, keys.select(key))
    return warehouse.physical(table).where(_within(schemas.PARTITION[table], months))


def upsert_by_id(
    warehouse: Warehouse, table: str, batch: DataFrame, key: str = "id_ticket_origem",
    sk: str | None = None, buckets: int = 4096,
) -> DataFrame:
    """Delete the keys of the batch wherever they are stored, then insert the batch.

    Keys are looked for only in the months whose summary has a block of theirs, and only the months that hold one of the
    keys, or receive a new row, are written anew; all of them switch to their new files once these are complete. A load
    that dies before leaves the table as it was. Running a load again gives the same table, surrogate keys included.
    """
    month = schemas.PARTITION[table]
    fresh = warehouse.stage(warehouse.shape(batch, table), f"{table}-batch")
    keys = fresh.select(key).distinct()
    held = [key, month] if sk is None else [key, month, sk]
    holding = _holding(warehouse, table, keys, key)
    found = warehouse.stage(holding.select(*held).join(keys, key, "left_semi"), f"{table}-found")
    keyed, last = (fresh, None) if sk is None else _keyed(warehouse, table, fresh, found, [key], sk, buckets)
    hit = _periods(found, month)
    incoming = _periods(fresh, month)
    # The stored keys of the batch are those found, mostly few, so the months written anew need not be dealt by key for them.
    gone = broadcast_few(found.select(key).distinct())
    kept = warehouse.physical(table).where(_within(month, hit | incoming)).join(gone, key, "left_anti")
    # A month that only loses rows may lose them all; it is switched to its new files all the same.
    warehouse.overwrite_partitions(kept.unionByName(keyed), table, emptied=sorted(hit - incoming, key=str), last_key=last)
    return warehouse.read(table)


def remove_by_id(warehouse: Warehouse, table: str, keys: DataFrame, key: str = "id_ticket_origem") -> None:
    """Delete the rows of some keys wherever they are stored."""
    month = schemas.PARTITION[table]
    hit = _periods(_holding(warehouse, table, keys, key).select(key, month).join(keys, key, "left_semi"), month)
    if hit:
        kept = warehouse.physical(table).where(_within(month, hit)).join(keys, key, "left_anti")
        last = warehouse.settled(table).last_key
        warehouse.overwrite_partitions(kept, table, emptied=sorted(hit, key=str), last_key=last)


def replace_period(
    warehouse: Warehouse, table: str, batch: DataFrame, sk: str | None = None,
    grain: Sequence[str] = (), buckets: int = 4096,
) -> DataFrame:
    """Replace every period present in the batch as a whole: rows missing from it disappear.

    Rows of a grain that the period held before keep their surrogate key.
    """
    fresh, last = warehouse.shape(batch, table), None
    warehouse.settled(table)
    if sk is not None:
        fresh = warehouse.stage(fresh, table)
        stored, month = warehouse.physical(table), schemas.PARTITION[table]
        known = stored.where(_within(month, _periods(fresh, month))).select(*grain, sk)
        fresh, last = _keyed(warehouse, table, fresh, known, grain, sk, buckets)
    warehouse.overwrite_partitions(fresh, table, last_key=last)
    return warehouse.read(table)


def replace_month_by_date(warehouse: Warehouse, table: str, batch: DataFrame, anomes: int) -> DataFrame:
    """Delete the rows dated in one month, then insert the batch.

    Rows of the batch dated elsewhere are appended, as an insert after that delete would do.
    """
    month = schemas.PARTITION[table]
    warehouse.settled(table)
    staged = warehouse.stage(warehouse.shape(batch, table), table)
    inside = staged.where(F.col(month) == anomes)
    warehouse.overwrite_partitions(inside, table, emptied=[anomes])
    outside = staged.where(~F.col(month).eqNullSafe(anomes))
    if not outside.isEmpty():
        warehouse.append(outside, table)
    return warehouse.read(table)
