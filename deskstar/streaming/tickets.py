"""The monthly ticket load as a stream of landed page files.

The idempotent upsert makes a replayed micro-batch harmless. The first copy of a ticket by landing position wins whatever
micro-batch it comes in: positions of loaded tickets are kept next to the tables, and a later copy is left out.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from deskstar import schemas
from deskstar.operators.joins import FEW_KEYS_LIMIT, broadcast_few, small
from deskstar.operators.upserts import remove_by_id
from deskstar.plans.dimensions import load_dimensions
from deskstar.plans.facts import load_fato_csi, load_fato_ticket
from deskstar.plans.monthly import PAGES
from deskstar.plans.refine import ORDER, build_curated_tickets, build_staging_tickets
from deskstar.sources.raw import CORRUPT, FILE, as_text, checked_lines, dedupe_landed_pages
from deskstar.sources.warehouse import Warehouse


def positions_path(warehouse: Warehouse) -> str:
    return f"{warehouse.root}/posicoes/fato_ticket"


def loaded_positions(warehouse: Warehouse) -> DataFrame:
    """Columns id and stored: the landing position of the copy that is loaded."""
    place = F.struct(*schemas.LANDING_POSITION.names)
    kept = T.StructType([schemas.RAW_TICKET["id"], *schemas.LANDING_POSITION.fields])
    try:
        rows = warehouse.spark.read.schema(kept).parquet(positions_path(warehouse))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = warehouse.spark.createDataFrame([], kept)
    return rows.groupBy("id").agg(F.min(place).alias("stored"))


def load_batch(
    warehouse: Warehouse, pages: DataFrame, mode: str, load_ts: Column | None = None, **dictionaries
) -> None:
    """One micro-batch through refine, dimensions and facts."""
    place = F.struct(*schemas.LANDING_POSITION.names)
    seen = warehouse.stage(dedupe_landed_pages(pages), "stream-seen")
    known = warehouse.stage(loaded_positions(warehouse).join(seen.select("id"), "id", "left_semi"), "stream-known")
    # Few tickets of a batch were loaded before, mostly; the batch is then read as stored and not shuffled for them.
    placed = seen.join(broadcast_few(known), "id", "left").where(F.col("stored").isNull() | (place <= F.col("stored")))
    if not small(known, FEW_KEYS_LIMIT):
        placed = warehouse.stage(placed, "stream-placed")
    earlier = placed.where(place < F.col("stored")).select(F.col("id").alias("id_ticket_origem"))
    first_seen = placed.drop("stored").withColumn(ORDER, place)
    staging = build_staging_tickets(first_seen.drop(*schemas.LANDING_POSITION.names))
    curated = warehouse.stage(build_curated_tickets(staging, unique=True, **dictionaries), "stream-curated")
    load_dimensions(warehouse, curated)
    # The earlier copy decides alone, also where a fact does not take it.
    for fact in () if earlier.isEmpty() else ("fato_ticket", "fato_csi"):
        remove_by_id(warehouse, fact, earlier)
    load_fato_ticket(warehouse, curated, mode, load_ts)
    load_fato_csi(warehouse, curated, mode, load_ts)
    fresh = placed.where(F.col("id").isNotNull() & (F.col("stored").isNull() | (place < F.col("stored"))))
    fresh.select("id", *schemas.LANDING_POSITION.names).write.mode("append").parquet(positions_path(warehouse))


def stream_tickets(
    warehouse: Warehouse,
    landing: str,
    checkpoint: str,
    mode: str = "quarantine",
    files_per_batch: int = 1000,
    load_ts: Column | None = None,
    **dictionaries,
) -> StreamingQuery:
    """Load every page file that is landed and not loaded yet, then stop."""
    lines = warehouse.spark.readStream.schema(as_text(PAGES)).option("columnNameOfCorruptRecord", CORRUPT)
    pages = lines.option("maxFilesPerTrigger", files_per_batch).json(landing).withColumn(FILE, F.col("_metadata.file_path"))
    return (
        pages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda df, _: load_batch(warehouse, checked_lines(df, PAGES, mode, warehouse), mode, load_ts, **dictionaries))
        .start()
    )
