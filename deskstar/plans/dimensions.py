"""Dimension loads: distinct members of the curated tickets that are not stored yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar import schemas, vocab
from deskstar.functions import text
from deskstar.operators.dedupe import canonical_server
from deskstar.operators.joins import attach_client_to_server
from deskstar.operators.members import (
    distinct_members,
    filter_nonblank_keys,
    insert_missing_members,
    seed_members,
    time_members,
    union_dates,
)
from deskstar.plans.refine import ORDER
from deskstar.sources.contracts import align_optional_columns, require_columns
from deskstar.sources.warehouse import Warehouse


def load_dim_tempo(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    cols = schemas.REQUIRED["curated_for_dates"]
    days = union_dates(require_columns(curated, cols), cols)
    return insert_missing_members(warehouse, time_members(days), "dim_tempo")


def client_members(curated: DataFrame) -> DataFrame:
    names = distinct_members(curated, "empresa", "nm_cliente", default=vocab.UNKNOWN_CUSTOMER)
    return names.withColumn("ativo", F.lit(True))


def load_dim_cliente(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    members = client_members(require_columns(curated, ["empresa"]))
    return insert_missing_members(warehouse, members, "dim_cliente")


def load_dim_tipo_ticket(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    members = distinct_members(require_columns(curated, ["tipo_ticket"]), "tipo_ticket", "nm_tipo_ticket")
    return insert_missing_members(warehouse, members, "dim_tipo_ticket")


def load_dim_status_ticket(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    members = distinct_members(
        require_columns(curated, ["status_ticket"]), "status_ticket", "nm_status_ticket"
    )
    return insert_missing_members(warehouse, members, "dim_status_ticket")


def load_dim_status_csi(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    members = distinct_members(
        require_columns(curated, ["csi_status"]), "csi_status", "nm_status_csi", casefold=True
    )
    return insert_missing_members(warehouse, members, "dim_status_csi", casefold=True)


def server_members(curated: DataFrame) -> DataFrame:
    """Named servers of the tickets, one canonical row per key, still with the customer name."""
    require_columns(curated, schemas.REQUIRED["curated_for_servers"])
    aligned = align_optional_columns(
        curated, schemas.CURATED_TICKETS, {"instancia": ""}, carry=(ORDER,)
    )
    attributes = ("empresa", "sgdb", "ambiente", "nome_servidor", "nk_servidor", "instancia")
    ordinal: Column = F.col(ORDER) if ORDER in aligned.columns else F.col("id_ticket")
    # Of tickets with the same attributes only the first can be chosen, so one each goes through the text work.
    # Within the struct an absent ordinal counts as the smallest, as in the order below.
    written = aligned.groupBy(*attributes).agg(F.min(F.struct(ordinal)).alias("_first"))
    clean = written.withColumns({c: text.normalise_text(F.col(c)) for c in attributes})
    named = filter_nonblank_keys(clean, ["nk_servidor", "nome_servidor"])
    return canonical_server(named, F.col("_first")).select(
        "nk_servidor",
        text.blank_to_default(F.col("instancia"), None).alias("instancia"),
        F.lit(None).cast("string").alias("host_name"),
        "nome_servidor",
        "ambiente",
        text.environment_macro(F.col("ambiente")).alias("ambiente_macro"),
        "sgdb",
        "empresa",
        F.lit(True).alias("ativo"),
    )


def load_dim_servidor(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    keyed = attach_client_to_server(server_members(curated), warehouse.read_dimension("dim_cliente"))
    return insert_missing_members(warehouse, keyed, "dim_servidor")


def load_dimensions(warehouse: Warehouse, curated: DataFrame) -> dict[str, DataFrame]:
    """All six dimensions; servers last because they refer to customers."""
    loaders = {
        "dim_tempo": load_dim_tempo,
        "dim_cliente": load_dim_cliente,
        "dim_tipo_ticket": load_dim_tipo_ticket,
        "dim_status_ticket": load_dim_status_ticket,
        "dim_status_csi": load_dim_status_csi,
        "dim_servidor": load_dim_servidor,
    }
    return {table: load(warehouse, curated) for table, load in loaders.items()}


def seed_domain_dims(warehouse: Warehouse) -> None:
    """Insert the fixed members of the four domain dimensions where absent."""
    for table in vocab.SEED_MEMBERS:
        members = seed_members(warehouse.spark, table)
        if table == "dim_cliente":
            members = members.withColumn("ativo", F.lit(True))
        insert_missing_members(warehouse, members, table)
