"""Approximate nearest neighbours by a permutation index, for the largest inner product.

A vector is represented by its ``prefix`` nearest pivots in order of nearness. Each shard of the index posts its vectors in
one inverted file per pivot with the pivot's rank. A query adds up, over the postings of its own pivots, what each shared
pivot takes off the footrule distance of the two orders; the nearest ``share`` of the shard by that distance are scored
exactly, and the best of all shards are merged. Every vector is posted; only the pivots are a bounded sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskstar.llm.common import staged
from deskstar.llm.vectors import identity, stacked, usable

FOUND = "query_id bigint, query_key bigint, vec_id bigint, score double"


def pivot_orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first, ties to the earlier pivot."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix]


def postings(orders: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pivot, the rows that list it and the rank they give it."""
    n, prefix = orders.shape
    by_pivot = np.argsort(orders.ravel(), kind="stable")
    ends = np.searchsorted(orders.ravel()[by_pivot], np.arange(pivots + 1))
    row, rank = np.divmod(by_pivot, prefix)
    return [(row[a:b], rank[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def closeness(order: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """What the shared pivots take off the footrule distance of a query to each of ``n`` rows.

    A pivot missing from one order counts as at rank ``prefix``; without any shared pivot every pair has the same distance,
    and one that both list at ranks r and s takes off twice ``prefix - max(r, s)``.
    """
    prefix = len(order)
    rows = np.concatenate([files[p][0] for p in order])
    off = np.concatenate([prefix - np.maximum(files[p][1], r) for r, p in enumerate(order)])
    return np.bincount(rows, weights=off, minlength=n)


def search(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
           neighbours: int = 20, pivots: int = 256, prefix: int = 64, share: float = 0.2,
           shard_rows: int = 4096, query_rows: int = 1024) -> DataFrame:
    """Columns query_id, rank (from 1), vec_id and score: the ``neighbours`` best found for each row of ``queries``.

    Nearest first, ties to the smaller id; a row is no neighbour of a query with its id. Rows with a null id, with a vector
    that is null, zero, or holds null or non-finite components, or of another length than most, take no part. Exact
    repeats of a row count once; copies of a vector under other ids are neighbours of their own. Other columns are
    ignored. Empty tables give an empty table. ``pivots`` bounds the sample of vectors that the index is fitted on.
    """
    def prepared(df: DataFrame) -> DataFrame:
        return usable(df, vec_id, embedding).where(F.col("vec_id").isNotNull()).withColumn("key", identity()["a"])

    rows = prepared(vectors)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = usual["n"] if usual else 0
    # Of equal vectors no more than this many smallest ids can be among the best.
    copies = Window.partitionBy("key", identity()["b"]).orderBy("vec_id")
    rows = rows.where(F.size("v") == dim).dropDuplicates(["vec_id", "key"]).withColumn("n", F.row_number().over(copies))
    rows = staged(rows.where(F.col("n") <= neighbours + 1).drop("n"), "vectors")
    asked = prepared(queries).where(F.size("v") == dim).dropDuplicates(["vec_id", "key"])
    asked = staged(asked, "queries")
    sample = rows.dropDuplicates(["key"]).orderBy("key").limit(pivots).select("v").collect()
    centre = np.array([r["v"] for r in sample], dtype=np.float64).reshape(len(sample), dim)
    wide = min(prefix, max(1, len(centre)))
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-asked.count() // query_rows))

    def dealt(df: DataFrame, mine: str, n: int, other: str, m: int) -> DataFrame:
        """Every row once for each block of the other side."""
        return df.withColumn(mine, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def best(index: pa.Table, wanted: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if index.num_rows and wanted.num_rows:
            ids = index.column("vec_id").to_numpy()
            x = np.stack(stacked(index.column("v")))
            files = postings(pivot_orders(x, centre, wide), len(centre))
            take = min(len(ids), max(neighbours + 1, int(np.ceil(share * len(ids)))))
            q = np.stack(stacked(wanted.column("v")))
            names, keys = wanted.column("vec_id").to_numpy(), wanted.column("key").to_numpy()
            for k, order in enumerate(pivot_orders(q, centre, wide)):
                near = closeness(order, files, len(ids))
                near = near.argpartition(-take)[-take:] if take < len(ids) else np.arange(len(ids))
                near = near[ids[near] != names[k]]
                score = (x[near] * q[k]).sum(axis=1)
                first = np.lexsort((ids[near], -score))[:neighbours]
                for column, values in zip(out, (np.full(len(first), names[k]), np.full(len(first), keys[k]),
                                                ids[near][first], score[first]), strict=True):
                    column.append(values)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(np.concatenate(c) if c else [], kind) for c, kind in zip(out, kinds, strict=True)],
                        names=["query_id", "query_key", "vec_id", "score"])

    index = dealt(rows, "shard", shards, "block", blocks).groupBy("shard", "block")
    wanted = dealt(asked, "block", blocks, "shard", shards).groupBy("shard", "block")
    found = index.cogroup(wanted).applyInArrow(best, FOUND)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select(
        "query_id", "rank", "vec_id", "score")
