"""Fact loads: prepare, resolve keys, check, de-duplicate, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar import schemas, vocab
from deskstar.functions import temporal, text
from deskstar.functions.numeric import coerce_numeric
from deskstar.operators.dedupe import keep_first
from deskstar.operators.joins import lookup_sk, lookup_sk_casefold, role_playing_dates
from deskstar.operators.members import (
    coalesce_enrich,
    filter_nonblank_keys,
    insert_missing_members,
    time_members,
)
from deskstar.operators.quality import reject_invalid_period, require_resolved_sk, split_invalid_period
from deskstar.operators.upserts import replace_month_by_date, replace_period, upsert_by_id
from deskstar.plans.refine import ORDER, filter_csi, filter_valid_id
from deskstar.sources.contracts import lower_names, require_columns
from deskstar.sources.warehouse import Warehouse

MEASURES = (
    "TAMANHO_GB", "DELTA_1_MES", "DELTA_2_MESES", "DELTA_3_MESES", "DELTA_6_MESES",
    "DELTA_12_MESES", "DISPONIBILIDADE_PCT", "MINUTOS_INDISPONIVEIS",
)


def _load_ts(load_ts: Column | None) -> Column:
    return F.current_timestamp() if load_ts is None else load_ts


def _by_file_order(df: DataFrame) -> list[Column]:
    return [F.col(ORDER)] if ORDER in df.columns else [F.col(c) for c in df.columns]


# --- tickets ---------------------------------------------------------------------------------------
def prepare_tickets(curated: DataFrame, texts: tuple[str, ...]) -> DataFrame:
    """Typed curated rows: numeric id, real dates, filled text, 1/0 flag."""
    typed = filter_valid_id(curated, "id_ticket", "id_ticket").withColumns(
        {
            "data_criacao": temporal.to_day(F.col("data_criacao")),
            "data_ultima_alteracao": temporal.to_day(F.col("data_ultima_alteracao")),
            "tempo_resolucao_horas": F.col("tempo_resolucao_horas").try_cast("decimal(12,2)"),
            **{c: text.normalise_text(F.col(c)) for c in texts},
        }
    )
    return typed.withColumn("foi_atuado", temporal.flag_to_int(F.col("foi_atuado")))


def ticket_fact(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    """Curated tickets with every key looked up, resolved or not."""
    require_columns(curated, schemas.REQUIRED["curated_for_tickets"])
    texts = ("empresa", "tipo_ticket", "status_ticket", "foi_atuado", "titulo_ticket", "nk_servidor")
    df = prepare_tickets(curated, texts).withColumn(
        "empresa", text.blank_to_default(F.col("empresa"), vocab.UNKNOWN_CUSTOMER)
    )
    spread = ["id_ticket"]
    df = lookup_sk(df, warehouse.read_dimension("dim_cliente"), "empresa", "nm_cliente", spread)
    df = lookup_sk(df, warehouse.read_dimension("dim_servidor"), "nk_servidor", "nk_servidor", spread)
    df = lookup_sk(df, warehouse.read_dimension("dim_tipo_ticket"), "tipo_ticket", "nm_tipo_ticket", spread)
    df = lookup_sk(df, warehouse.read_dimension("dim_status_ticket"), "status_ticket", "nm_status_ticket", spread)
    roles = {"data_criacao": "sk_tempo_criacao", "data_ultima_alteracao": "sk_tempo_ultima_alt"}
    return role_playing_dates(df, warehouse.read_dimension("dim_tempo"), roles, spread)


def _stored_for_rejects(warehouse: Warehouse, keyed: DataFrame, label: str, mode: str) -> DataFrame:
    """In quarantine the rows are read twice, for the rejects and for the batch, so the lookups are stored."""
    return keyed if mode == "strict" else warehouse.stage(keyed, label)


def _keep_rejects(
    warehouse: Warehouse, bad: DataFrame, table: str, keys: list[str], mandatory: dict[str, str], mode: str
) -> None:
    """In quarantine, store the rows whose mandatory keys did not resolve, with the columns at fault."""
    if mode == "strict":
        return
    faults = [F.when(F.col(sk).isNull(), F.lit(source)) for sk, source in mandatory.items()]
    warehouse.reject(bad, table, keys, F.concat_ws(", ", *faults))


TICKET_MANDATORY = {
    "sk_cliente": "empresa", "sk_tipo_ticket": "tipo_ticket", "sk_tempo_criacao": "data_criacao",
}


def load_fato_ticket(
    warehouse: Warehouse, curated: DataFrame, mode: str = "strict", load_ts: Column | None = None
) -> DataFrame:
    keyed = _stored_for_rejects(warehouse, ticket_fact(warehouse, curated), "fato_ticket-keyed", mode)
    good, bad = require_resolved_sk(keyed, TICKET_MANDATORY, mode)
    _keep_rejects(warehouse, bad, "fato_ticket", ["id_ticket"], TICKET_MANDATORY, mode)
    unique = keep_first(good, ["id_ticket"], _by_file_order(good))
    batch = unique.withColumnRenamed("id_ticket", "id_ticket_origem").withColumn("data_carga", _load_ts(load_ts))
    return upsert_by_id(warehouse, "fato_ticket", batch, sk="sk_ticket")


# --- improvement tickets -----------------------------------------------------------------------------
def csi_fact(warehouse: Warehouse, curated: DataFrame) -> DataFrame:
    """Improvement tickets with their keys; a blank customer stays without a key here."""
    require_columns(curated, schemas.REQUIRED["curated_for_csi"])
    texts = ("empresa", "foi_atuado", "titulo_ticket", "csi_status", "nk_servidor")
    df = prepare_tickets(filter_csi(curated), texts)
    spread = ["id_ticket"]
    df = lookup_sk(df, warehouse.read_dimension("dim_cliente"), "empresa", "nm_cliente", spread)
    df = lookup_sk(df, warehouse.read_dimension("dim_servidor"), "nk_servidor", "nk_servidor", spread)
    df = lookup_sk_casefold(
        df, warehouse.read_dimension("dim_status_csi"), "csi_status", "nm_status_csi", spread
    )
    roles = {"data_criacao": "sk_tempo_criacao", "data_ultima_alteracao": "sk_tempo_fechamento"}
    return role_playing_dates(df, warehouse.read_dimension("dim_tempo"), roles, spread)


CSI_MANDATORY = {"sk_status_csi": "csi_status", "sk_tempo_criacao": "data_criacao"}


def load_fato_csi(
    warehouse: Warehouse, curated: DataFrame, mode: str = "strict", load_ts: Column | None = None
) -> DataFrame:
    keyed = _stored_for_rejects(warehouse, csi_fact(warehouse, curated), "fato_csi-keyed", mode)
    good, bad = require_resolved_sk(keyed, CSI_MANDATORY, mode)
    _keep_rejects(warehouse, bad, "fato_csi", ["id_ticket"], CSI_MANDATORY, mode)
    unique = keep_first(good, ["id_ticket"], _by_file_order(good))
    batch = unique.withColumnsRenamed(
        {"id_ticket": "id_ticket_origem", "titulo_ticket": "titulo_csi"}
    ).withColumn("data_carga", _load_ts(load_ts))
    return upsert_by_id(warehouse, "fato_csi", batch, sk="sk_fato_csi")


# --- servers -----------------------------------------------------------------------------------------
WRITTEN = "_anomes"  # the month as the file has it


def valid_periods(warehouse: Warehouse | None, dated: DataFrame, table: str, mode: str) -> DataFrame:
    """Rows whose month parses; in strict mode another one fails the job, in quarantine it is kept with the rejects."""
    if mode != "strict" and warehouse is not None:
        _, bad = split_invalid_period(dated, "DATA_REFERENCIA")
        bad = bad.withColumn("ANOMES", F.col(WRITTEN)).drop(WRITTEN)
        warehouse.reject(bad, table, ["INSTANCIA", "HOST_NAME", "ANOMES"], F.lit("ANOMES"))
    return reject_invalid_period(dated, "DATA_REFERENCIA", WRITTEN, mode).drop(WRITTEN)


def prepare_servers(staging: DataFrame, mode: str = "strict", warehouse: Warehouse | None = None) -> DataFrame:
    """Typed monthly rows with reference date and natural key, first row per (server, month).

    Rows that a load does not take are kept in ``warehouse.rejected("fato_servidor")`` where a warehouse is given: those
    without a server name in both modes, those whose month does not parse in quarantine. The month is kept as written.
    """
    require_columns(staging, schemas.REQUIRED["staging_servers"])
    typed = coerce_numeric(staging, MEASURES).withColumns(
        {
            WRITTEN: F.col("ANOMES").cast("string"),
            "ANOMES": F.col("ANOMES").try_cast("int"),
            "INSTANCIA": text.normalise_text(F.col("INSTANCIA")),
            "HOST_NAME": text.normalise_text(F.col("HOST_NAME")),
        }
    )
    dated = typed.withColumn("DATA_REFERENCIA", temporal.yyyymm_to_date(F.col("ANOMES")))
    if warehouse is not None:
        # Read for the rejects and for the rows that go on; what the staging comes out of is computed once.
        dated = warehouse.stage(dated, "servers-dated")
    valid = valid_periods(warehouse, dated, "fato_servidor", mode)
    keyed = valid.withColumn(
        "NK_SERVIDOR", text.server_natural_key(F.col("HOST_NAME"), F.col("INSTANCIA"))
    )
    named = filter_nonblank_keys(keyed, ["NK_SERVIDOR"])
    if warehouse is not None:
        nameless = keyed.where(text.normalise_text(F.col("NK_SERVIDOR")) == "")
        warehouse.reject(nameless, "fato_servidor", ["INSTANCIA", "HOST_NAME", "ANOMES"], F.lit("NK_SERVIDOR"))
    return keep_first(named, ["NK_SERVIDOR", "ANOMES"], server_order(named))


def server_order(df: DataFrame) -> list[Column]:
    """The order of the staging file: latest month first, then instance."""
    if ORDER in df.columns:
        return [F.col(ORDER)]
    rest = [F.col(c) for c in ("HOST_NAME", *MEASURES)]
    return [F.col("ANOMES").desc_nulls_last(), F.col("INSTANCIA"), *rest]


def feed_servers(prepared: DataFrame) -> DataFrame:
    """Servers named by the feed, first row per key, with the attributes the feed knows."""
    host = text.blank_to_default(F.col("HOST_NAME"), None)
    instance = text.blank_to_default(F.col("INSTANCIA"), None)
    first = keep_first(prepared, ["NK_SERVIDOR"], server_order(prepared))
    return first.select(
        F.col("NK_SERVIDOR").alias("nk_servidor"),
        instance.alias("instancia"),
        host.alias("host_name"),
        text.combine_first(host, instance).alias("nome_servidor"),
        F.lit(True).alias("ativo"),
    )


def load_feed_dimensions(warehouse: Warehouse, prepared: DataFrame) -> None:
    """Reference months, servers not known yet, then blank attributes of the known ones."""
    days = prepared.select(F.col("DATA_REFERENCIA").alias("data_completa")).distinct()
    insert_missing_members(warehouse, time_members(days), "dim_tempo")
    servers = warehouse.stage(feed_servers(prepared), "feed-servers")
    insert_missing_members(warehouse, servers, "dim_servidor")
    attributes = ["instancia", "host_name", "nome_servidor"]
    enriched = coalesce_enrich(warehouse.read("dim_servidor"), servers, "nk_servidor", attributes)
    warehouse.replace(enriched, "dim_servidor")


SERVER_MANDATORY = {"sk_servidor": "NK_SERVIDOR", "sk_tempo_referencia": "DATA_REFERENCIA"}


def server_fact(warehouse: Warehouse, prepared: DataFrame) -> DataFrame:
    spread = ["NK_SERVIDOR", "ANOMES"]
    df = lookup_sk(prepared, warehouse.read_dimension("dim_servidor"), "NK_SERVIDOR", "nk_servidor", spread)
    roles = {"DATA_REFERENCIA": "sk_tempo_referencia"}
    return role_playing_dates(df, warehouse.read_dimension("dim_tempo"), roles, spread)


def load_fato_servidor(
    warehouse: Warehouse,
    staging: DataFrame,
    source: str | None = None,
    mode: str = "strict",
    load_ts: Column | None = None,
) -> DataFrame:
    """Reference months, servers and the monthly fact out of one staging file.

    Rows name ``source`` as their file, or without one their own ``arquivo_origem`` where the staging has it.
    """
    prepared = warehouse.stage(prepare_servers(staging, mode, warehouse), "servers")
    load_feed_dimensions(warehouse, prepared)
    good, bad = require_resolved_sk(server_fact(warehouse, prepared), SERVER_MANDATORY, mode)
    _keep_rejects(warehouse, bad, "fato_servidor", ["NK_SERVIDOR", "ANOMES"], SERVER_MANDATORY, mode)
    unique = keep_first(good, ["sk_servidor", "sk_tempo_referencia"], server_order(good))
    own = source is None and "arquivo_origem" in unique.columns
    origin = F.col("arquivo_origem") if own else F.lit(source)
    batch = lower_names(unique).withColumns({"arquivo_origem": origin.cast("string"), "data_carga": _load_ts(load_ts)})
    grain = ["sk_servidor", "sk_tempo_referencia"]
    return replace_period(warehouse, "fato_servidor", batch, sk="sk_fato_servidor", grain=grain)


# --- flat tables of the legacy generation ---------------------------------------------------------------
def load_flat_servers(warehouse: Warehouse, staging: DataFrame, mode: str = "strict") -> DataFrame:
    require_columns(staging, schemas.REQUIRED["staging_servers"])
    typed = coerce_numeric(staging, MEASURES).withColumns(
        {WRITTEN: F.col("ANOMES").cast("string"), "ANOMES": F.col("ANOMES").try_cast("int")})
    dated = typed.withColumn("DATA_REFERENCIA", temporal.yyyymm_to_date(F.col("ANOMES")))
    valid = valid_periods(warehouse, dated, "fato_servidores_mensal", mode)
    unique = keep_first(valid, ["INSTANCIA", "ANOMES"], server_order(valid))
    return replace_period(warehouse, "fato_servidores_mensal", lower_names(unique))


def load_flat_tickets(warehouse: Warehouse, curated: DataFrame, anomes: int) -> DataFrame:
    require_columns(curated, schemas.REQUIRED["curated_legacy"])
    texts = ("empresa", "tipo_ticket", "status_ticket", "foi_atuado", "titulo_ticket", "csi_status")
    typed = filter_valid_id(curated, "id_ticket", "id_ticket").withColumns(
        {
            "data_criacao": temporal.to_day(F.col("data_criacao")),
            "data_ultima_alteracao": temporal.to_day(F.col("data_ultima_alteracao")),
            **{c: text.normalise_text(F.col(c)) for c in texts},
        }
    )
    return replace_month_by_date(warehouse, "fato_tickets", typed, anomes)
