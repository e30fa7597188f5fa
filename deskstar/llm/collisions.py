"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Distinct unit vectors are projected on random directions. Two vectors collide in a projection if one lies in the window of
half width ``h`` around the other. At the bar's distance d a projection's difference is normal with deviation d, so
collisions at the bar are binomial with a known rate; pairs whose count reaches the calibrated number are verified by
their cosine, and a pair at the bar is missed with a chance of at most ``miss``.

The vectors are cut into blocks along the first projection. A pair of blocks meets if their ranges come within the window
of one another that holds all but ``miss`` of the pairs at the bar. In a pair, each projection of the one block is sorted,
windows of the other become ranges of ranks, and counts add up rank comparisons. A block that ties have made larger than
asked for is split by a hash of the ids. What leaves a pair of blocks is a number of links and a root for each row that
has any, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskstar.llm.common import components, mapped, staged
from deskstar.llm.vectors import identity, stacked, usable

ROWS_AT_ONCE = 128


def collision_rate(half_width: float, distance: float) -> float:
    return math.erf(half_width / (distance * math.sqrt(2.0)))


def calibrated(projections: int, rate: float, miss: float) -> int:
    """The largest count that a pair with this collision rate fails to reach with a chance of at most ``miss``."""
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * rate ** count * (1 - rate) ** (projections - count)
        if below > miss:
            return count
    return projections


def reaching(p: np.ndarray, q: np.ndarray, half_width: float, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``p``, row of ``q``) that collide in at least ``count`` projections, some rows of ``p`` at a time."""
    ranks, low, wide = [], [], []
    kind = np.uint16 if len(q) < 1 << 16 else np.uint32
    for k in range(p.shape[1]):
        order = np.argsort(q[:, k], kind="stable")
        rank = np.empty(len(q), dtype=kind)
        rank[order] = np.arange(len(q))
        a, b = (np.searchsorted(q[order, k], p[:, k] + s * half_width, side) for s, side in ((-1, "left"), (1, "right")))
        ranks.append(rank)
        low.append(a.astype(kind))
        wide.append((b - a).astype(kind))
    for start in range(0, len(p), ROWS_AT_ONCE):
        part = slice(start, start + ROWS_AT_ONCE)
        hits = np.zeros((len(p[part]), len(q)), dtype=np.uint8)
        for rank, a, w in zip(ranks, low, wide, strict=True):
            hits += rank[None, :] - a[part, None] < w[part, None]
        i, j = np.nonzero(hits >= count)
        yield i + start, j


def rooted(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, once the links ``a``-``b`` are added to components named by ``root``."""
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        root = root.copy()
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def links(classes: DataFrame, dim: int, threshold: float, projections: int, miss: float, block_rows: int,
          seed: int) -> DataFrame:
    """What ``classes`` (id, n, v) link with, one row per class and pair of blocks: columns id, root and m.

    ``m`` is the number of vectors linked there, ``root`` the smallest id reached by links of that pair of blocks.
    """
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((dim, projections))
    distance = math.sqrt(2.0 - 2.0 * threshold)
    half_width = 1.5 * distance
    count = calibrated(projections, collision_rate(half_width, distance), miss)
    reach = distance
    while collision_rate(reach, distance) < 1 - miss:
        reach *= 1.05

    def project(batch: pa.RecordBatch):
        v = np.stack(stacked(batch.column(2)))
        p = (v / np.sqrt((v * v).sum(axis=1))[:, None]) @ directions[:, 0]
        yield pa.record_batch([*batch.columns, pa.array(p)], ["id", "n", "v", "p"])

    placed = staged(mapped(classes, project, "id bigint, n bigint, v array<double>, p double"), "projected")
    blocks = max(1, -(-placed.count() // block_rows))
    cuts = placed.approxQuantile("p", [k / blocks for k in range(1, blocks)], 0.1 / blocks) if blocks > 1 else []
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<double>")

    def block(p):
        return F.size(F.filter(edges, lambda c: c <= p))

    placed = placed.withColumn("block", block(F.col("p")))
    held = {r["block"]: r["count"] for r in placed.groupBy("block").count().collect()}
    parts = F.array(*[F.lit(-(-held.get(k, 1) // (2 * block_rows))) for k in range(len(cuts) + 1)])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("block") + 1)).cast("int"))

    def every_part(of: str):
        return F.explode(F.sequence(F.lit(0), F.element_at(parts, F.col(of) + 1) - 1))

    one = placed.select("id", "n", "v", F.col("block").alias("i"), F.col("part").alias("s"), F.explode(
        F.sequence(F.col("block"), block(F.col("p") + reach))).alias("j")).withColumn("t", every_part("j"))
    two = placed.select("id", "n", "v", F.col("block").alias("j"), F.col("part").alias("t"), F.explode(
        F.sequence(block(F.col("p") - reach), F.col("block"))).alias("i")).withColumn("s", every_part("i"))
    once = F.expr("i < j or s <= t")

    def verified(x: pa.Table, y: pa.Table) -> pa.Table:
        ids = m = root = np.zeros(0, dtype=np.int64)
        if x.num_rows and y.num_rows:
            v, w = np.stack(stacked(x.column("v"))), np.stack(stacked(y.column("v")))
            lengths = np.sqrt((v * v).sum(axis=1)), np.sqrt((w * w).sum(axis=1))
            ids, node = np.unique(np.concatenate([x.column("id").to_numpy(), y.column("id").to_numpy()]), return_inverse=True)
            left, right = node[:len(v)], node[len(v):]
            n_left, n_right = x.column("n").to_numpy(), y.column("n").to_numpy()
            m, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
            same = all(x.column(k)[0].as_py() == x.column(l)[0].as_py() for k, l in (("i", "j"), ("s", "t")))
            for i, j in reaching(v / lengths[0][:, None] @ directions, w / lengths[1][:, None] @ directions, half_width,
                                 count):
                ordered = left[i] < right[j] if same else left[i] != right[j]
                i, j = i[ordered], j[ordered]
                near = np.concatenate([(v[i[k:k + 65536]] * w[j[k:k + 65536]]).sum(axis=1) / (
                    lengths[0][i[k:k + 65536]] * lengths[1][j[k:k + 65536]]) >= threshold
                    for k in range(0, len(i), 65536)] or [np.zeros(0, dtype=bool)])
                i, j = i[near], j[near]
                np.add.at(m, left[i], n_right[j])
                np.add.at(m, right[j], n_left[i])
                root = rooted(root, left[i], right[j])
        linked = m > 0
        return pa.table({"id": ids[linked], "root": ids[root[linked]], "m": m[linked]})

    key, columns = ["i", "s", "j", "t"], ["i", "s", "j", "t", "id", "n", "v"]
    met = one.where(once).select(*columns).groupBy(*key).cogroup(two.where(once).select(*columns).groupBy(*key))
    return met.applyInArrow(verified, "id bigint, root bigint, m bigint")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                    projections: int = 40, miss: float = 1e-4, block_rows: int = 4096, seed: int = 5) -> DataFrame:
    """Columns vec_id, n_links, component_id and kept for every row of ``vectors``.

    Two rows link if the cosine of their vectors is at least ``threshold``. Equal vectors link without a comparison, and
    only one of them is compared with others. Vectors that are null, zero, or hold null or non-finite components, and rows
    with a null id, link with nothing; vectors of different lengths do not link. Rows that repeat an id are rows of their
    own and link like others. A component is named by its smallest id, and the row with that id is kept; a row with a
    null id is its own component and is kept. Other columns are ignored. An empty table gives an empty table.
    """
    good = usable(vectors, vec_id, embedding).where(F.col("vec_id").isNotNull())
    good = good.select("vec_id", "v", identity()["a"].alias("a"), identity()["b"].alias("b"))
    classes = staged(good.groupBy("a", "b").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"),
                                                F.first("v").alias("v")), "classes")
    # Two vectors may share their smallest id, so classes get numbers of their own below.
    numbered = staged(classes.withColumn("number", F.monotonically_increasing_id()), "numbered")
    dims = [r["d"] for r in numbered.select(F.size("v").alias("d")).distinct().collect()]
    found = None
    for dim in sorted(dims):
        part = links(numbered.where(F.size("v") == dim).select(F.col("number").alias("id"), "n", "v"), dim, threshold,
                     projections, miss, block_rows, seed)
        found = part if found is None else found.union(part)
    own = numbered.select("number", "id", "n", "a", "b")
    if found is None:
        summary = own.select("a", "b", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    else:
        found = staged(found, "links")
        degree = found.groupBy(F.col("id").alias("number")).agg(F.sum("m").alias("m"))
        group = components(found, "id", "root").withColumnRenamed("id", "number").withColumnRenamed("component", "root")
        joined = own.join(degree, "number", "left").join(group, "number", "left").withColumn(
            "root", F.coalesce("root", "number"))
        names = joined.groupBy("root").agg(F.min("id").alias("component"))
        summary = joined.join(names, "root").select(
            "a", "b", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"), "component")
    every = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias(embedding))
    v = usable_vector(every, embedding)
    keyed = every.select("vec_id", v.alias("v")).select(
        "vec_id", F.when(F.col("v").isNotNull() & F.col("vec_id").isNotNull(), identity()).alias("k"))
    keyed = keyed.select("vec_id", F.col("k")["a"].alias("a"), F.col("k")["b"].alias("b"))
    out = keyed.join(summary, ["a", "b"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def usable_vector(vectors: DataFrame, embedding: str):
    """The vector where it takes part, else null."""
    v = F.col(embedding).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(whole & F.exists(v, lambda x: x != 0.0), v)
