"""Helpers shared by the operators: tables, staged results, Arrow batches and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = "2m"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; in local mode, one of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts the lineage.

    The files may be expired once the result that is built on them has been written. The shuffles of the write are of no
    use afterwards, so Spark is told to remove them with it.
    """
    df.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = f"{shared_folder(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, batch: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` by a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                yield from batch(part)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession, size: str = BATCH_BYTES) -> None:
    """Python steps get their rows in batches of about ``size`` instead of 10,000 rows, however long the texts are.

    Executors keep their Python workers from step to step, and a worker and its JVM keep much of what their largest batch
    took. A size that the caller has set stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have (names compare without case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_pattern() -> str:
    """A word of the size measure: a run of anything but the six ASCII blanks."""
    return r"[^\x20\x09-\x0D]+"


def bytes_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Smallest id reachable from each id of ``edges``: columns ``id`` and ``component``.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains
    shorten by doubling. Every round is a written table; a hub's messages are folded before the shuffle.
    """
    forward = edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
    backward = edges.select(F.col(right).alias("a"), F.col(left).alias("b"))
    both = staged(forward.union(backward).where("a <> b").distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                    .select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        heard = (both.join(labels.withColumnRenamed("id", "b"), "b")
                 .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard")))
        lower = labels.join(heard, "id").select("id", "component", F.least("component", "heard").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("component").alias("further"))
        fresh = staged(lower.join(jump, "low").select(
            "id", F.least("low", "further").alias("component"),
            (F.least("low", "further") < F.col("component")).alias("moved")), "labels")
        moved = fresh.where("moved").limit(1).count()
        labels = fresh.select("id", "component")
        if not moved:
            return labels
