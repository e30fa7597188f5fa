"""Keep-first de-duplication with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order; NULL keys form one group.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each task sends at most
    one row per key, so a key that holds a third of the rows does not land in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def canonical_server(servers: DataFrame, ordinal: Column) -> DataFrame:
    """One row per server key: smallest customer, environment, product and name; then file order."""
    order = [F.col(c) for c in ("empresa", "ambiente", "sgdb", "nome_servidor")]
    return keep_first(servers, ["nk_servidor"], [*order, ordinal])
