"""Key lookups and set-style joins that keep their shape under skew."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar.functions.text import strip

# A side is broadcast only below this planned size, whatever the session threshold is.
BROADCAST_LIMIT = 32 * 1024 * 1024
# Files of bare keys are packed tighter than the names of a dimension, so fewer of their bytes are broadcast.
FEW_KEYS_LIMIT = 4 * 1024 * 1024
# Types whose equal values have equal hashes on both sides of a join.
HASHED_TYPES = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp"}


def planned_bytes(df: DataFrame) -> int:
    """Size estimate of the optimised plan; for a scan it is the size of the files read."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return planned_bytes(df) <= limit


def broadcast_few(rows: DataFrame) -> DataFrame:
    """Stored keys marked for broadcast where their files are small, so that what they are joined with is not shuffled."""
    return F.broadcast(rows) if small(rows, FEW_KEYS_LIMIT) else rows


def hot_keys(fact: DataFrame, keys: Sequence[str], tasks: int) -> dict[int, int]:
    """Hash of each key that holds more than two tasks' worth of the rows, and over how many tasks to spread it.

    The counts come from a frequency sketch: one pass over the key columns, a bounded sketch per task, and at most
    ``tasks / 2`` keys in the result. A count off by the sketch's error changes how a key is spread, never the rows.
    Rows with a null in the key are left out.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    tracked = min(max(20 * tasks, 10_000), 1_000_000)
    found = fact.where(known).select(F.xxhash64(*keys).alias("h")).agg(
        F.call_function("approx_top_k", F.col("h"), F.lit(max(1, tasks // 2)), F.lit(tracked)).alias("top"),
        F.count("*").alias("n")).first()
    return {r["item"]: min(tasks, math.ceil(r["count"] * tasks / found["n"])) for r in found["top"] or ()
            if r["count"] * tasks > 2 * found["n"]}


def left_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    spread_by: Sequence[str],
    tasks: int | None = None,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Left equi-join of a large table with a lookup side; the lookup's key columns are dropped.

    A lookup side below ``limit`` is broadcast. For a larger one the fact's hot keys are found first (a job over its key
    columns): their rows are spread over tasks by a hash of ``spread_by``, and only their lookup rows are repeated, in all
    at most as often as there are ``tasks`` (default: the shuffle partitions) and hot keys. Rows with a null in the key
    match nothing and are spread without a copy. Keys of other types than ``HASHED_TYPES``, or of unlike types, are not
    spread. Every match is found in all ways.
    """
    renamed = dim.withColumnsRenamed({d: f"_k{i}" for i, (_, d) in enumerate(on)})
    condition = [F.col(f) == F.col(f"_k{i}") for i, (f, _) in enumerate(on)]
    keys = [f"_k{i}" for i in range(len(on))]
    if small(renamed, limit):
        return fact.join(F.broadcast(renamed), condition, "left").drop(*keys)
    tasks = tasks or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sources = [f for f, _ in on]
    types = [(fact.schema[f].dataType.simpleString(), renamed.schema[k].dataType.simpleString())
             for f, k in zip(sources, keys, strict=True)]
    alike = all(a == b and a in HASHED_TYPES for a, b in types)
    hot = hot_keys(fact, sources, tasks) if alike else {}

    def copies(*names: str) -> Column:
        if not hot:
            return F.lit(1)
        entries = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
        h = F.xxhash64(*names)
        return F.when(h.isin(*hot), entries[h]).otherwise(F.lit(1))

    blank = F.lit(False)
    for f in sources:
        blank = blank | F.col(f).isNull()
    wide = F.when(blank, F.lit(tasks)).otherwise(copies(*sources))
    salted = fact.withColumn("_s", F.pmod(F.xxhash64(*spread_by), wide).cast("int"))
    repeated = renamed.withColumn("_t", F.explode(F.sequence(F.lit(0), copies(*keys) - 1)) if hot else F.lit(0))
    joined = salted.join(repeated, [*condition, F.col("_s") == F.col("_t")], "left")
    return joined.drop(*keys, "_s", "_t")


def lookup_sk(
    fact: DataFrame, dim: DataFrame, source: str, nk: str, spread_by: Sequence[str], **options
) -> DataFrame:
    """Natural key to surrogate key: exact and case-sensitive."""
    return left_lookup(fact, dim, [(source, nk)], spread_by, **options)


def lookup_sk_casefold(
    fact: DataFrame, dim: DataFrame, source: str, nk: str, spread_by: Sequence[str], **options
) -> DataFrame:
    """Lookup on trimmed lower-case text; a dimension with the text in two casings fans out."""
    folded = dim.withColumn(nk, F.lower(strip(F.col(nk))))
    probe = fact.withColumn("_folded", F.lower(strip(F.coalesce(F.col(source), F.lit("")))))
    return left_lookup(probe, folded, [("_folded", nk)], spread_by, **options).drop("_folded")


def table_lookup(
    df: DataFrame, key: Column, dictionary: DataFrame, into: str, spread_by: Sequence[str], default: str | None = None, **options
) -> DataFrame:
    """Column ``into``: the value that a dictionary table (columns key and value, in this order) has for ``key``.

    An absent or NULL key, and a NULL value, give ``default``. Keys are compared in the dictionary's type; a code that does
    not fit it is absent. A key with two different values fails the job; NULL keys of the dictionary match nothing. The
    dictionary may be of any size: it is broadcast only below the checked limit.
    """
    k, v = dictionary.columns
    one = dictionary.where(F.col(k).isNotNull()).groupBy(F.col(k).alias("_entry")).agg(
        F.min(v).alias("_value"), F.count_distinct(F.col(v)).alias("_values"))
    ambiguous = F.concat(F.lit(f"{into}: two values for "), F.col("_entry").cast("string"))
    one = one.select("_entry", F.when(F.col("_values") > 1, F.raise_error(ambiguous)).otherwise(F.col("_value")).alias("_value"))
    probe = df.withColumn("_asked", key.try_cast(dictionary.schema[k].dataType))
    found = left_lookup(probe, one, [("_asked", "_entry")], spread_by, **options)
    return found.withColumn(into, F.coalesce("_value", F.lit(default))).drop("_asked", "_value")


def role_playing_dates(
    fact: DataFrame, dim_tempo: DataFrame, roles: dict[str, str], spread_by: Sequence[str], **options
) -> DataFrame:
    """The time dimension joined once per role: ``{date column: key column}``."""
    for source, sk in roles.items():
        dates = dim_tempo.select(F.col("sk_tempo").alias(sk), F.col("data_completa"))
        fact = left_lookup(fact, dates, [(source, "data_completa")], spread_by, **options)
    return fact


def attach_client_to_server(servers: DataFrame, dim_cliente: DataFrame) -> DataFrame:
    """Customer name to ``sk_cliente``; the name is dropped and a blank one stays NULL."""
    keyed = lookup_sk(servers, dim_cliente, "empresa", "nm_cliente", ["nk_servidor"])
    return keyed.drop("empresa")


def anti_new_members(candidates: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not in the table yet; existing keys never reach the driver."""
    return candidates.join(existing.select(*keys), list(keys), "left_anti")


def semi_delete(table: DataFrame, batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows removed) when the keys of the batch are deleted from the table."""
    doomed = batch.select(*keys).distinct()
    return table.join(doomed, list(keys), "left_anti"), table.join(doomed, list(keys), "left_semi")


def null_or_predicate(df: DataFrame, *cols: str) -> DataFrame:
    """Rows of an outer join in which at least one side is present."""
    present = F.lit(False)
    for c in cols:
        present = present | F.col(c).isNotNull()
    return df.where(present)


def merge_outer_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join that fails when a key repeats on either side; NULL keys match each other.

    A one-to-one outer join is a union folded by key: one shuffle for both sides, rows combined in
    the map tasks, and the row count per side that the check needs. Columns that both sides have
    get the suffixes ``_left`` and ``_right``.
    """
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    sides = {"left": left, "right": right}
    values = {s: [c for c in df.columns if c not in keys] for s, df in sides.items()}

    def tagged(side: str) -> DataFrame:
        packed = F.struct(*values[side]).alias(f"_{side}")
        return sides[side].select(*keys, packed)

    both = tagged("left").unionByName(tagged("right"), allowMissingColumns=True)
    folded = both.groupBy(*keys).agg(
        *[F.count(f"_{s}").alias(f"_n_{s}") for s in sides],
        *[F.any_value(f"_{s}", F.lit(True)).alias(f"_{s}") for s in sides],
    )

    def checked(side: str) -> Column:
        repeated = F.raise_error(F.concat(F.lit(f"{side} repeats key "), F.to_json(F.struct(*keys))))
        return F.when(F.col(f"_n_{side}") > 1, repeated).otherwise(F.col(f"_{side}")).alias(f"_{side}")

    def named(side: str) -> list[Column]:
        return [
            F.col(f"_{side}.{c}").alias(f"{c}_{side}" if c in shared else c) for c in values[side]
        ]

    return folded.select(*keys, *[checked(s) for s in sides]).select(
        *keys, *named("left"), *named("right")
    )
