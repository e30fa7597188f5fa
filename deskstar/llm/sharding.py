"""Sharding: a uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

1. Every input partition puts its rows in random order and numbers them (no exchange).
2. The matrix says how many rows of each partition go to each cell; its row sums are the partition sizes, its column sums
   the cell sizes, and it has the law that a uniform permutation of all rows would give it. It is drawn by halving the
   list of partitions: the cells of the upper half follow a multivariate hypergeometric law given the whole.
3. A row's number in its partition and the partition's row of the matrix give its cell; rows move to their cells, and
   each cell is put in random order again.

A shard is one cell, or several of at most ``cell_rows`` rows, so that the last permutation is as parallel as the data
need. The matrix holds partitions x cells numbers and nothing of the rows. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskstar.llm.common import staged, unused

POSITION_BITS = 33  # monotonically_increasing_id: the partition above, the position in it below


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) decided by ``parts``."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(pool: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``marked`` among ``pool`` are in ``draws`` taken without return, by inversion at ``u``.

    Outcomes further than nine standard deviations from the mean, which a double cannot tell from impossible, are left
    out; the law within is summed by the ratio of neighbours.
    """
    p, m, t = pool.cast("double"), marked.cast("double"), draws.cast("double")
    mean = m * t / F.greatest(p, F.lit(1.0))
    spread = F.sqrt(mean * (F.greatest(p - m, F.lit(0.0)) / F.greatest(p, F.lit(1.0)))
                    * (F.greatest(p - t, F.lit(0.0)) / F.greatest(p - 1.0, F.lit(1.0))))
    reach = F.ceil(spread * 9.0) + F.lit(6)
    low = F.greatest(F.lit(0), draws - (pool - marked), F.floor(mean) - reach).cast("long")
    high = F.least(marked, draws, F.ceil(mean) + reach).cast("long")

    def ratio(k: Column) -> Column:
        return (m - k) * (t - k) / ((k + 1.0) * (p - m - t + k + 1.0))

    def chosen(ends: Column) -> Column:
        support = F.sequence(ends["low"], ends["high"])
        start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), ends["low"].alias("k"))
        total = F.aggregate(support, start, lambda s, k: F.struct(
            (s["p"] * ratio(k.cast("double"))).alias("p"), (s["sum"] + s["p"]).alias("sum"), s["k"].alias("k")),
            lambda s: s["sum"])

        def find(goal: Column) -> Column:
            return F.aggregate(support, start, lambda s, k: F.struct(
                (s["p"] * ratio(k.cast("double"))).alias("p"), (s["sum"] + s["p"]).alias("sum"),
                F.when(s["sum"] <= goal, k).otherwise(s["k"]).alias("k")), lambda s: s["k"])

        return F.when(ends["low"] >= ends["high"], ends["low"]).otherwise(let(total * u, find))

    return let(F.struct(low.alias("low"), high.alias("high")), chosen)


def split_cells(cells: Column, draws: Column, seed: int, *node: Column) -> Column:
    """Of the rows wanted by ``cells``, how many each cell takes from a part that holds ``draws`` of them."""
    begin = F.struct(draws.cast("long").alias("draws"),
                     F.aggregate(cells, F.lit(0).cast("long"), lambda a, b: a + b).alias("pool"),
                     F.array().cast("array<bigint>").alias("out"))

    def step(s: Column, cell: Column) -> Column:
        u = uniform(seed, F.size(s["out"]), *node)
        return let(hypergeometric(s["pool"], cell, s["draws"], u), lambda x: F.struct(
            (s["draws"] - x).alias("draws"), (s["pool"] - cell).alias("pool"),
            F.concat(s["out"], F.array(x)).alias("out")))

    return F.aggregate(cells, begin, step, lambda s: s["out"])


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, b: a + b)


def communication_matrix(sizes: DataFrame, partitions: int, cells: Column, seed: int) -> DataFrame:
    """Rows ``part, cells array<bigint>``: how many rows of a partition each cell gets.

    ``sizes`` is one row with an array ``sizes`` of ``partitions`` numbers.
    """
    nodes = sizes.select(F.lit(0).cast("long").alias("first"), "sizes", cells.alias("cells"))
    width = partitions
    level = 0
    while width > 1:
        half = F.shiftright(F.size("sizes") + 1, 1)
        upper = F.slice("sizes", F.lit(1), half)
        lower = F.slice("sizes", half + 1, F.greatest(F.size("sizes") - half, F.lit(0)))
        parted = nodes.select(
            "first", "cells", upper.alias("upper"), lower.alias("lower"), half.alias("half")).withColumn(
            "mine", split_cells(F.col("cells"), total(F.col("upper")), seed, F.lit(level), F.col("first")))
        both = F.explode(F.array(
            F.struct(F.col("first"), F.col("upper").alias("sizes"), F.col("mine").alias("cells")),
            F.struct((F.col("first") + F.col("half")).alias("first"), F.col("lower").alias("sizes"),
                     F.zip_with("cells", "mine", lambda a, b: a - b).alias("cells"))))
        nodes = parted.select(both.alias("n")).select("n.*").where(F.size("sizes") > 0)
        width = (width + 1) // 2
        level += 1
    return nodes.select(F.col("first").alias("part"), "cells")


def cell_sizes(rows: int, shards: int, per_shard: int) -> Column:
    """Sizes of all cells, shard by shard: shards at most one apart, and so the cells of a shard."""
    def of(s: Column) -> Column:
        return F.lit(rows // shards).cast("long") + (s < rows % shards).cast("long")

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.transform(
        F.sequence(F.lit(0), F.lit(per_shard - 1)),
        lambda c: F.floor(of(s) / per_shard).cast("long") + (c < F.pmod(of(s), F.lit(per_shard))).cast("long"))))


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 1, cell_rows: int = 1_000_000) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in the shard): a uniform shuffle.

    Row counts of shards are at most one apart; equal, null or repeated rows are rows like others, and with fewer rows
    than shards some shards stay empty. Columns of these names (case aside) are replaced. A seed gives the same result
    over the same files and split settings. An empty table gives an empty table.
    """
    base = rows.drop("shard", "slot")
    mark, spot = unused(base, "part_mark"), unused(base, "part_spot")
    number = F.monotonically_increasing_id()
    local = base.withColumn(mark, F.rand(seed)).sortWithinPartitions(mark).withColumn(spot, number).drop(mark)
    local = staged(local, "permuted")
    part = F.shiftright(spot, POSITION_BITS)
    position = F.col(spot).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    counts = local.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    known = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, partitions = int(known[0]), int(known[1])
    per_shard = max(1, -(-n // (shards * cell_rows)))
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("l")).select(
        F.col("l")["n"].alias("sizes"), F.col("l")["part"].alias("parts"))
    listed = staged(listed, "sizes")
    matrix = communication_matrix(listed.select("sizes"), partitions, cell_sizes(n, shards, per_shard), seed)
    names = listed.select(F.posexplode("parts").alias("part", "name"))
    ends = matrix.join(names, "part").select(
        F.col("name").alias("part"), F.transform(
            F.sequence(F.lit(1), F.size("cells")), lambda k: total(F.slice("cells", F.lit(1), k))).alias("ends"))
    ends = staged(ends, "matrix")
    cell = unused(base, "cell")
    home, edges = unused(base, "home"), unused(base, "ends")
    ends = ends.select(F.col("part").alias(home), F.col("ends").alias(edges))
    # The first cell whose end lies beyond the position, by halving.
    steps = max(1, (shards * per_shard).bit_length())
    search = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("a"), F.lit(shards * per_shard - 1).alias("b")),
        lambda s, _: let(F.shiftright(s["a"] + s["b"], 1), lambda mid: F.when(
            F.element_at(F.col(edges), mid + 1) > position, F.struct(s["a"].alias("a"), mid.alias("b"))).otherwise(
            F.struct(F.least(mid + 1, s["b"]).alias("a"), s["b"].alias("b")))), lambda s: s["a"])
    moved = local.withColumn(home, part).join(ends, home).withColumn(cell, search).drop(home, edges)
    again = Window.partitionBy(cell).orderBy(F.xxhash64(F.lit(seed + 1), F.col(spot)), F.col(spot))
    before = F.floor(F.col(cell) % F.lit(per_shard))
    rank = (F.row_number().over(again) - 1).cast("long")
    shard = F.floor(F.col(cell) / F.lit(per_shard)).cast("int")
    of = F.lit(n // shards).cast("long") + (shard < n % shards).cast("long")
    skipped = before * F.floor(of / per_shard) + F.least(before, F.pmod(of, F.lit(per_shard)))
    return moved.withColumn("shard", shard).withColumn("slot", rank + skipped).drop(cell, spot)
