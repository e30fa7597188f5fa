"""A corpus from raw documents: five stages, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar.llm import language, line_dedup, mixing, near_documents, pieces
from deskstar.llm.common import documents, small_batches, staged, unused
from deskstar.llm.queries import VOCABULARY
from deskstar.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MIN_SCORE = 0.3  # a language's own texts score above 0.4, whatever their length


def bounded(stage: Stage) -> Stage:
    """A stage by small batches: five stages share the Python workers of an executor, and each leaves them larger."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or unlike every language go."""
    name = unused(docs, "found")
    found = docs.withColumn(name, language.predicted(F.col("text"), language.learn(docs)))
    keep = (F.col(name)["lang"] != language.UNKNOWN) & (F.col(name)["score"] >= MIN_SCORE)
    return found.where(keep).drop(name)


@bounded
def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them share; n_chars follows the text."""
    name = unused(docs, "lines")
    kept = line_dedup.drop_shared_lines(docs, into=name)
    return kept.withColumn("text", F.col(name)["text"]).drop(name).withColumn(
        "n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@bounded
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept document of each group of near-duplicates: the one with the smallest id."""
    return near_documents.without_near_duplicates(docs, floor=0.0)


@bounded
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut gives its first words only."""
    return mixing.repeated(docs)


@bounded
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's pieces, and whether they decode to its text."""
    vocabulary = pieces.read_vocabulary(VOCABULARY)
    found = docs.select("doc_id", "source", "text", pieces.round_trip(spark, F.col("text"), vocabulary).alias("found"))
    ids = F.col("found")["piece_ids"]
    return found.select("doc_id", "source", F.size(ids).cast("long").alias("n_pieces"), ids.alias("piece_ids"),
                        F.col("found")["text"].eqNullSafe(F.col("text")).alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identified),
    ("lines", without_shared_lines),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed),
    ("pieces", encoded),
]

# Language profiles, sampled signatures and piece segmentation are not SQL; tests hold the stages to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
