"""One month end to end: stages in dependency order, the first failure stops the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar import schemas, vocab
from deskstar.operators.capacity import month_bounds
from deskstar.plans.dimensions import load_dimensions
from deskstar.plans.facts import load_fato_csi, load_fato_servidor, load_fato_ticket, load_flat_servers, load_flat_tickets
from deskstar.plans.refine import (
    ORDER,
    build_curated_tickets,
    build_curated_tickets_legacy,
    build_staging_servers,
    build_staging_tickets,
)
from deskstar.sources.contracts import require_columns
from deskstar.sources.layers import layer_path, load_lineage_columns, read_delimited_auto, write_layer
from deskstar.sources.raw import dedupe_landed_pages, read_raw_monitoring, read_raw_tickets
from deskstar.sources.warehouse import Warehouse
from pyspark.sql.types import StructType

PAGES = StructType([*schemas.RAW_TICKET.fields, *schemas.LANDING_POSITION.fields])


@dataclass(frozen=True)
class MonthlyInputs:
    """Landed files of one run; a feed may be absent.

    ``servers`` is a staged server file, or a folder of such files, and takes the place of the two feeds.
    """

    tickets: str
    volumetry: str | None = None
    availability: str | None = None
    multi_line: bool = False
    servers: str | None = None

    def __post_init__(self) -> None:
        if self.servers and (self.volumetry or self.availability):
            raise ValueError("give either a staged server file or the feeds it is made of")


def read_month(spark: SparkSession, lake: str, layer: str, entity: str, anomes: int) -> DataFrame:
    df = spark.read.parquet(layer_path(lake, layer, entity))
    return df.where(F.col("anomes") == anomes)


def stage_tickets_month(spark: SparkSession, lake: str, anomes: int, raw: DataFrame) -> DataFrame:
    """Landed pages to the staging layer of one month."""
    first_seen = dedupe_landed_pages(raw).withColumn(ORDER, F.struct(*schemas.LANDING_POSITION.names))
    staging = build_staging_tickets(first_seen.drop(*schemas.LANDING_POSITION.names))
    write_layer(staging, lake, "staging", "tickets", anomes)
    return read_month(spark, lake, "staging", "tickets", anomes).drop("anomes")


def refine_tickets_month(
    spark: SparkSession, lake: str, anomes: int, raw: DataFrame, **dictionaries
) -> DataFrame:
    """Landed pages to the staging and curated layers of one month."""
    stored = stage_tickets_month(spark, lake, anomes, raw)
    write_layer(build_curated_tickets(stored, **dictionaries), lake, "curated", "tickets", anomes)
    return read_month(spark, lake, "curated", "tickets", anomes)


def refine_servers(spark: SparkSession, inputs: MonthlyInputs, host_name: str | None = None) -> DataFrame:
    """Landed monitoring documents to server staging rows."""

    def feed(path: str | None, name: str) -> DataFrame | None:
        if path is None:
            return None
        rows = read_raw_monitoring(spark, path, name, host_name=host_name, multi_line=inputs.multi_line)
        return rows.drop("pos", "arquivo")

    return build_staging_servers(
        feed(inputs.volumetry, "volumetry"), feed(inputs.availability, "availability"), ordered=False
    )


def read_staged_servers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Rows of staged server files as text, in file order, each with the file that it came from.

    A file without one of the staging columns is refused. The loads coerce the values.
    """
    rows = read_delimited_auto(spark, path, order_col=ORDER, multi_line=multi_line)
    require_columns(rows, schemas.REQUIRED["staging_servers"])
    return load_lineage_columns(rows).select(*schemas.STAGING_SERVERS.names, ORDER, "arquivo_origem")


def month_of(year: int, month: int) -> int:
    start, _ = month_bounds(year, month)
    return start.year * 100 + start.month


def staged_servers(spark: SparkSession, lake: str, warehouse: Warehouse, inputs: MonthlyInputs) -> DataFrame | None:
    """The server rows of a run: the staged file as it is, or the feeds by way of the staging layer."""
    if inputs.servers:
        return read_staged_servers(spark, inputs.servers, inputs.multi_line)
    if not (inputs.volumetry or inputs.availability):
        return None
    staging = warehouse.stage(refine_servers(spark, inputs), "staging-servers")
    write_layer(staging, lake, "staging", "servidores")
    return staging


def run_month(
    spark: SparkSession,
    lake: str,
    warehouse: Warehouse,
    year: int,
    month: int,
    inputs: MonthlyInputs,
    mode: str = "strict",
    load_ts: Column | None = None,
    **dictionaries,
) -> Warehouse:
    """Land, refine and load one month of tickets, then the staged server file or the monitoring feeds if given."""
    anomes = month_of(year, month)
    raw = read_raw_tickets(spark, inputs.tickets, schema=PAGES, multi_line=inputs.multi_line, mode=mode, warehouse=warehouse)
    curated = refine_tickets_month(spark, lake, anomes, raw, **dictionaries)
    load_dimensions(warehouse, curated)
    load_fato_ticket(warehouse, curated, mode, load_ts)
    load_fato_csi(warehouse, curated, mode, load_ts)
    servers = staged_servers(spark, lake, warehouse, inputs)
    if servers is not None:
        load_fato_servidor(warehouse, servers, inputs.volumetry or inputs.availability, mode, load_ts)
    return warehouse


def run_month_legacy(
    spark: SparkSession,
    lake: str,
    warehouse: Warehouse,
    year: int,
    month: int,
    inputs: MonthlyInputs,
    mode: str = "strict",
    **dictionaries,
) -> Warehouse:
    """One month of the legacy generation: the flat ticket table, then the flat server table if servers are given."""
    anomes = month_of(year, month)
    raw = read_raw_tickets(spark, inputs.tickets, schema=PAGES, multi_line=inputs.multi_line, mode=mode, warehouse=warehouse)
    curated = build_curated_tickets_legacy(stage_tickets_month(spark, lake, anomes, raw), **dictionaries)
    write_layer(curated, lake, "curated", "tickets_legado", anomes)
    load_flat_tickets(warehouse, read_month(spark, lake, "curated", "tickets_legado", anomes).drop("anomes"), anomes)
    servers = staged_servers(spark, lake, warehouse, inputs)
    if servers is not None:
        load_flat_servers(warehouse, servers, mode)
    return warehouse
