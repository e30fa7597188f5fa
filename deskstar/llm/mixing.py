"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Targets: every source would get its weight's share of the wanted total; a source stops at ``max_epochs`` times its own
size and its excess goes to the others by weight, until none is above. With sources in order of size per weight the
clamped ones come first, so running sums give the level at which that process ends.

Sampling: a source repeats all its documents ``floor(target / size)`` times. For the rest, its documents stand in an order
drawn from the seed and are taken from the front; the one at the cut gives only the words still missing. The order is
cut in two steps, by sums per bucket and then inside the one bucket that holds the cut, so no source is ever sorted
or gathered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskstar.llm.common import staged, unused, words_pattern

BUCKET_DIGITS = 3  # hex digits: 4096 buckets a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(words_pattern())), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` (source, source_size, weight) with the double ``target``.

    One row per source; the running sums over them are the only step that is not spread.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    wanted = F.sum("source_size").over(everything) * F.lit(share)
    level = (wanted - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    leveled = sources.withColumn("_level", level)
    # The first source that the level does not fill ends the clamping; with none, all stop at their caps.
    first = F.min(F.when(F.col("_level") * F.col("weight") <= cap, F.struct(
        cap / F.col("weight"), F.coalesce(F.col("source"), F.lit("")), F.col("_level").alias("level")))).over(everything)
    return (leveled.withColumn("_found", first["level"])
            .withColumn("target", F.when(F.col("_found").isNull(), cap).otherwise(
                F.least(cap, F.col("_found") * F.col("weight"))))
            .drop("_level", "_found"))


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Weights dealt in turn to the sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    return sources.withColumn("weight", dealt)


def cuts(rows: DataFrame, weights: tuple[int, ...], share: float, max_epochs: float) -> DataFrame:
    """One row per source of ``rows`` (source, size, drawn): its plan, the bucket of its cut and the words missing there."""
    buckets = staged(rows.groupBy("source", bucket_of(F.col("drawn")).alias("bucket")).agg(F.sum("size").alias("words")),
                     "buckets")
    sources = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(cyclic_weights(sources, weights), share, max_epochs)
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("rest", goal - F.col("whole") * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("bucket")
    placed = buckets.withColumn("upto", F.sum("words").over(running))
    placed = placed.join(plan, placed["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    missing = F.col("rest") - F.col("upto") + F.col("words")
    first = placed.where(F.col("upto") >= F.col("rest")).groupBy("source").agg(
        F.min(F.struct("bucket", missing.alias("missing"))).alias("cut"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.first("whole").alias("whole"))
    return staged(first.select(F.col("source").alias("name"), F.struct(
        "source_size", "target", "whole", "cut.bucket", "cut.missing").alias("plan")), "cuts")


def bucket_of(drawn: Column) -> Column:
    return F.substring(drawn, 1, BUCKET_DIGITS)


def draw(doc_id: Column, seed: int) -> Column:
    """Where a document stands in its source's order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def taken(rows: DataFrame, plans: DataFrame, source: str, own: str) -> DataFrame:
    """``rows`` with the struct ``own`` (size, drawn) extended by source_size, target and taken.

    Only the rows in the bucket of a source's cut are put in order.
    """
    name, plan = unused(rows, "name"), unused(rows, "plan")
    joined = rows.join(plans.toDF(name, plan), F.col(source).eqNullSafe(F.col(name)))
    bucket, size = bucket_of(F.col(own)["drawn"]), F.col(own)["size"]

    def ended(part: Column) -> Column:
        return F.struct(size.alias("size"), F.col(plan)["source_size"].alias("source_size"),
                        F.col(plan)["target"].alias("target"), (F.col(plan)["whole"] * size + part).alias("taken"))

    plain = joined.where(bucket != F.col(plan)["bucket"]).withColumn(
        own, ended(F.when(bucket < F.col(plan)["bucket"], size).otherwise(F.lit(0).cast("long"))))
    front = Window.partitionBy(name).orderBy(F.col(own)["drawn"], size).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum(size).over(front), F.lit(0))
    inside = joined.where(bucket == F.col(plan)["bucket"]).withColumn(
        own, ended(F.greatest(F.lit(0), F.least(size, F.col(plan)["missing"] - spent)).cast("long")))
    return plain.unionByName(inside).drop(name, plan)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7,
        ) -> DataFrame:
    """Columns doc_id, size, source_size, target and taken of every row of ``docs``.

    ``size`` counts the words of the text (null: 0) and ``taken`` those that the mix takes, repeats counted; the taken
    words of a source sum to its rounded target. Null sources are one source, and an empty text is never taken.
    Repeated rows are rows of their own; documents whose order hash ties (equal ids) go by size. Other columns are
    dropped, so none can clash. An empty table gives an empty table.
    """
    rows = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                              word_count(F.col(text)).alias("size"), draw(F.col(doc_id), seed).alias("drawn")), "sizes")
    plans = cuts(rows, weights, share, max_epochs)
    mixed = taken(rows.select("doc_id", "source", F.struct("size", "drawn").alias("own")), plans, "source", "own")
    return mixed.select("doc_id", "own.size", "own.source_size", "own.target", "own.taken")


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7,
             ) -> DataFrame:
    """``docs`` as the mix takes them: a document taken twice is two rows, one not taken is none.

    The document at the cut of a source adds a row with only the words still missing, its first ones with single spaces.
    All columns pass through. See ``mix`` for the options and for nulls, ties, empty texts and empty tables.
    """
    size, drawn = word_count(F.col(text)), draw(F.col(doc_id), seed)
    rows = staged(docs.select(F.col(source).alias("source"), size.alias("size"), drawn.alias("drawn")), "sizes")
    plans = cuts(rows, weights, share, max_epochs)
    own, copy = unused(docs, "own"), unused(docs, "copy")
    mixed = taken(docs.withColumn(own, F.struct(size.alias("size"), drawn.alias("drawn"))), plans, source, own)
    mixed = mixed.where(F.col(own)["taken"] > 0)
    times = F.ceil(F.col(own)["taken"] / F.col(own)["size"]).cast("int")
    rows = mixed.withColumn(copy, F.explode(F.sequence(F.lit(1), times)))
    missing = F.col(own)["taken"] - (F.col(copy) - 1) * F.col(own)["size"]
    words = F.slice(F.regexp_extract_all(text, F.lit(words_pattern()), F.lit(0)), F.lit(1), missing.cast("int"))
    whole = missing >= F.col(own)["size"]
    return rows.withColumn(text, F.when(whole, F.col(text)).otherwise(F.concat_ws(" ", words))).select(*docs.columns)
