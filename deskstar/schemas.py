"""Declared schemas of every layer and warehouse table."""

from __future__ import annotations

from pyspark.sql import types as T


# Types are added by name, which needs no running session.
_TYPE_NAMES = {"BIGINT": "long", "INT": "integer", "SMALLINT": "short"}


def columns(spec: str) -> T.StructType:
    """``name TYPE`` pairs separated by a comma and a blank."""
    struct = T.StructType()
    for item in spec.split(", "):
        name, kind = item.strip("`").replace("` ", " ").rsplit(" ", 1)
        struct.add(name, _TYPE_NAMES.get(kind, kind.lower()))
    return struct


def _feed(items: T.StructType) -> T.StructType:
    results = T.ArrayType(T.StructType().add("items", T.ArrayType(items)))
    return columns("instancia STRING, host_name STRING").add("results", results)


# --- raw documents -----------------------------------------------------------------------------
RAW_TICKET = columns(
    "id BIGINT, company_id BIGINT, subject STRING, status STRING, priority INT, type STRING, "
    "created_at STRING, updated_at STRING"
).add("custom_fields", columns("cf_sgdb STRING, cf_ambiente STRING, cf_csi_status STRING"))
# Position of a ticket in the landed result pages.
LANDING_POSITION = columns("window_start DATE, page INT, pos BIGINT")

RAW_AVAILABILITY = _feed(
    columns("anomes STRING, disponibilidade_pct STRING, minutos_indisponiveis STRING")
)
RAW_VOLUMETRY = _feed(
    columns("db STRING, mes STRING, gb_total STRING, diff_1m STRING, diff_3m STRING, diff_6m STRING, diff_12m STRING")
)

# --- lake layers -------------------------------------------------------------------------------
STAGING_TICKETS = columns(
    "id BIGINT, company_id BIGINT, subject STRING, status STRING, priority INT, type STRING, "
    "created_at STRING, updated_at STRING, `custom_fields.cf_sgdb` STRING, "
    "`custom_fields.cf_ambiente` STRING, `custom_fields.cf_csi_status` STRING"
)
STAGING_SERVERS = columns(
    "INSTANCIA STRING, HOST_NAME STRING, ANOMES INT, TAMANHO_GB DOUBLE, DELTA_1_MES DOUBLE, "
    "DELTA_2_MESES DOUBLE, DELTA_3_MESES DOUBLE, DELTA_6_MESES DOUBLE, DELTA_12_MESES DOUBLE, "
    "DISPONIBILIDADE_PCT DOUBLE, MINUTOS_INDISPONIVEIS INT"
)
CURATED_TICKETS = columns(
    "id_ticket BIGINT, empresa STRING, data_criacao STRING, data_ultima_alteracao STRING, "
    "tipo_ticket STRING, status_ticket STRING, foi_atuado STRING, titulo_ticket STRING, "
    "csi_status STRING, sgdb STRING, ambiente STRING, nome_servidor STRING, instancia STRING, "
    "nk_servidor STRING, tempo_resolucao_horas DECIMAL(12,2)"
)
CURATED_TICKETS_LEGACY = columns(
    "id_ticket BIGINT, empresa STRING, data_criacao STRING, data_ultima_alteracao STRING, "
    "tipo_ticket STRING, status_ticket STRING, foi_atuado STRING, titulo_ticket STRING, "
    "csi_status STRING"
)

# Columns each job refuses to run without.
REQUIRED = {
    "staging_tickets": ("id", "subject", "status", "created_at", "updated_at"),
    "staging_tickets_legacy": ("id", "status", "created_at", "updated_at"),
    "staging_servers": tuple(STAGING_SERVERS.names),
    "curated_for_dates": ("data_criacao", "data_ultima_alteracao"),
    "curated_for_servers": ("empresa", "sgdb", "ambiente", "nome_servidor", "nk_servidor"),
    "curated_for_tickets": (
        "id_ticket", "empresa", "data_criacao", "data_ultima_alteracao", "tipo_ticket",
        "status_ticket", "foi_atuado", "titulo_ticket", "nk_servidor", "tempo_resolucao_horas",
    ),
    "curated_for_csi": (
        "id_ticket", "empresa", "data_criacao", "data_ultima_alteracao", "tipo_ticket",
        "foi_atuado", "titulo_ticket", "csi_status", "nk_servidor", "tempo_resolucao_horas",
    ),
    "curated_legacy": tuple(CURATED_TICKETS_LEGACY.names),
}

# --- warehouse ---------------------------------------------------------------------------------
_COLUMNS = {
    "dim_tempo": (
        "sk_tempo INT, data_completa DATE, "
        "ano SMALLINT, mes SMALLINT, dia SMALLINT, anomes INT, "
        "nome_mes STRING, trimestre SMALLINT, semestre SMALLINT"
    ),
    "dim_cliente": "sk_cliente BIGINT, nm_cliente STRING, ativo BOOLEAN",
    "dim_servidor": (
        "sk_servidor BIGINT, nk_servidor STRING, "
        "instancia STRING, host_name STRING, nome_servidor STRING, ambiente STRING, "
        "ambiente_macro STRING, sgdb STRING, sk_cliente BIGINT, "
        "ativo BOOLEAN"
    ),
    "dim_tipo_ticket": "sk_tipo_ticket BIGINT, nm_tipo_ticket STRING",
    "dim_status_ticket": "sk_status_ticket BIGINT, nm_status_ticket STRING",
    "dim_status_csi": "sk_status_csi BIGINT, nm_status_csi STRING",
    "fato_ticket": (
        "sk_ticket BIGINT, id_ticket_origem BIGINT, "
        "sk_cliente BIGINT, sk_servidor BIGINT, sk_tipo_ticket BIGINT, "
        "sk_status_ticket BIGINT, sk_tempo_criacao INT, sk_tempo_ultima_alt INT, "
        "foi_atuado SMALLINT, "
        "tempo_resolucao_horas DECIMAL(12,2), "
        "titulo_ticket STRING, data_carga TIMESTAMP"
    ),
    "fato_servidor": (
        "sk_fato_servidor BIGINT, sk_servidor BIGINT, "
        "sk_tempo_referencia INT, tamanho_gb DECIMAL(14,2), delta_1_mes DECIMAL(14,2), "
        "delta_2_meses DECIMAL(14,2), delta_3_meses DECIMAL(14,2), delta_6_meses DECIMAL(14,2), "
        "delta_12_meses DECIMAL(14,2), disponibilidade_pct DECIMAL(7,2), "
        "minutos_indisponiveis INT, arquivo_origem STRING, data_carga TIMESTAMP"
    ),
    "fato_csi": (
        "sk_fato_csi BIGINT, id_ticket_origem BIGINT, sk_cliente BIGINT, "
        "sk_servidor BIGINT, sk_status_csi BIGINT, sk_tempo_criacao INT, "
        "sk_tempo_fechamento INT, titulo_csi STRING, foi_atuado SMALLINT, "
        "tempo_resolucao_horas DECIMAL(12,2), data_carga TIMESTAMP"
    ),
    "map_servidor_instancia": "instancia STRING, host_name STRING",
    "fato_servidores_mensal": (
        "instancia STRING, host_name STRING, anomes INT, data_referencia DATE, "
        "tamanho_gb DECIMAL(14,2), delta_1_mes DECIMAL(14,2), delta_2_meses DECIMAL(14,2), "
        "delta_3_meses DECIMAL(14,2), delta_6_meses DECIMAL(14,2), delta_12_meses DECIMAL(14,2), "
        "disponibilidade_pct DECIMAL(7,2), minutos_indisponiveis INT"
    ),
    "fato_tickets": (
        "id_ticket BIGINT, empresa STRING, data_criacao DATE, data_ultima_alteracao DATE, "
        "tipo_ticket STRING, status_ticket STRING, foi_atuado STRING, titulo_ticket STRING, "
        "csi_status STRING"
    ),
}

# Comments of the columns whose meaning is not their name.
COMMENTS = {
    "sk_tempo": "day key YYYYMMDD",
    "anomes": "month as YYYYMM",
    "nome_mes": "month name in Portuguese",
    "nk_servidor": "normalised name",
    "ambiente_macro": "production or not",
    "id_ticket_origem": "id in the desk",
    "foi_atuado": "1 acted on, 0 not",
    "tempo_resolucao_horas": "last change minus creation",
}

TABLE = {name: columns(spec) for name, spec in _COLUMNS.items()}

# The nine tables of the star, dimensions first.
STAR_TABLES = (
    "dim_tempo", "dim_cliente", "dim_servidor", "dim_tipo_ticket", "dim_status_ticket",
    "dim_status_csi", "fato_ticket", "fato_servidor", "fato_csi",
)

# Physical partition column of the tables that are rewritten period by period. A column absent
# from the declared schema is technical: derived on write, dropped on read.
PARTITION = {
    "fato_ticket": "mes_criacao",
    "fato_csi": "mes_criacao",
    "fato_servidor": "sk_tempo_referencia",
    "fato_servidores_mensal": "anomes",
    "fato_tickets": "mes_criacao",
}

# dimension -> (surrogate key, natural key)
# Facts whose months keep a summary of this id.
SUMMARISED = {"fato_ticket": "id_ticket_origem", "fato_csi": "id_ticket_origem"}

DIMENSION_KEYS = {
    "dim_tempo": ("sk_tempo", "data_completa"),
    "dim_cliente": ("sk_cliente", "nm_cliente"),
    "dim_servidor": ("sk_servidor", "nk_servidor"),
    "dim_tipo_ticket": ("sk_tipo_ticket", "nm_tipo_ticket"),
    "dim_status_ticket": ("sk_status_ticket", "nm_status_ticket"),
    "dim_status_csi": ("sk_status_csi", "nm_status_csi"),
}

# fact -> foreign keys as (column, dimension, nullable)
FOREIGN_KEYS = {
    "fato_ticket": (
        ("sk_cliente", "dim_cliente", False),
        ("sk_servidor", "dim_servidor", True),
        ("sk_tipo_ticket", "dim_tipo_ticket", False),
        ("sk_status_ticket", "dim_status_ticket", True),
        ("sk_tempo_criacao", "dim_tempo", False),
        ("sk_tempo_ultima_alt", "dim_tempo", True),
    ),
    "fato_servidor": (
        ("sk_servidor", "dim_servidor", False),
        ("sk_tempo_referencia", "dim_tempo", False),
    ),
    "fato_csi": (
        ("sk_cliente", "dim_cliente", True),
        ("sk_servidor", "dim_servidor", True),
        ("sk_status_csi", "dim_status_csi", True),
        ("sk_tempo_criacao", "dim_tempo", False),
        ("sk_tempo_fechamento", "dim_tempo", True),
    ),
    "dim_servidor": (("sk_cliente", "dim_cliente", True),),
}

UNIQUE_KEYS = {
    "dim_tempo": ("data_completa",),
    "dim_cliente": ("nm_cliente",),
    "dim_servidor": ("nk_servidor",),
    "dim_tipo_ticket": ("nm_tipo_ticket",),
    "dim_status_ticket": ("nm_status_ticket",),
    "dim_status_csi": ("nm_status_csi",),
    "fato_ticket": ("id_ticket_origem",),
    "fato_servidor": ("sk_servidor", "sk_tempo_referencia"),
    "fato_csi": ("id_ticket_origem",),
}

# table -> {constraint name: SQL predicate that must not be false}
CHECKS = {
    "fato_ticket": {"hours_not_negative": "tempo_resolucao_horas >= 0"},
    "fato_csi": {"hours_not_negative": "tempo_resolucao_horas >= 0"},
    "fato_servidor": {"availability_is_percentage": "disponibilidade_pct BETWEEN 0 AND 100"},
    "dim_servidor": {"macro_environment_domain": "ambiente_macro IN ('Produção', 'Não Produção')"},
}
