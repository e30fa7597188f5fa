"""Raw documents to staging, staging to curated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar import schemas, vocab
from deskstar.functions import temporal, text
from deskstar.operators.dedupe import keep_first
from deskstar.operators.joins import merge_outer_one_to_one
from deskstar.sources.contracts import align_optional_columns, flatten_json, quoted, require_columns

# Technical column that carries the file order through the layers.
ORDER = "ordem"
TECHNICAL = (ORDER, "anomes")


def filter_valid_id(df: DataFrame, source: str, name: str) -> DataFrame:
    """Numeric id under its warehouse name; rows without one are dropped."""
    return df.withColumn(name, quoted(source).try_cast("bigint")).where(F.col(name).isNotNull())


def filter_csi(df: DataFrame, column: str = "tipo_ticket") -> DataFrame:
    return df.where(F.upper(text.normalise_text(F.col(column))) == "CSI")


def project_staging_tickets(flat: DataFrame) -> DataFrame:
    """The eleven staging columns in contract order, then the technical ones."""
    return align_optional_columns(flat, schemas.STAGING_TICKETS, carry=TECHNICAL)


def build_staging_tickets(raw: DataFrame) -> DataFrame:
    """Nested raw tickets to flat staging rows, narrow and without a shuffle."""
    return project_staging_tickets(flatten_json(raw, keep=TECHNICAL))


def order_staging_desc_nulls_last(df: DataFrame) -> DataFrame:
    """Latest month first, rows without a valid month last, instances in order."""
    month = temporal.yyyymm_to_date(F.col("ANOMES"))
    return df.orderBy(month.desc_nulls_last(), F.col("INSTANCIA").asc_nulls_last())


def build_staging_servers(
    volumetry: DataFrame | None, availability: DataFrame | None, ordered: bool = True
) -> DataFrame:
    """Join the two monthly feeds one to one on (instance, month); either may be absent."""
    if volumetry is None and availability is None:
        raise ValueError("no monitoring feed given")
    if volumetry is None or availability is None:
        merged = volumetry if availability is None else availability
    else:
        both = merge_outer_one_to_one(volumetry, availability, ["INSTANCIA", "ANOMES"])
        host = text.combine_first(F.col("HOST_NAME_left"), F.col("HOST_NAME_right"))
        merged = both.withColumn("HOST_NAME", host)
    staging = align_optional_columns(merged, schemas.STAGING_SERVERS)
    return order_staging_desc_nulls_last(staging) if ordered else staging


def _order_of(df: DataFrame) -> list[Column]:
    """Given file order, or a total order over the columns when the source has none."""
    return [F.col(ORDER)] if ORDER in df.columns else [quoted(c) for c in df.columns]


def build_curated_tickets(
    staging: DataFrame,
    codes: Mapping[int, str] = vocab.CUSTOMER_CODES,
    patterns: Sequence[tuple[str, str]] = vocab.CUSTOMER_PATTERNS,
    title_customers: Sequence[str] = vocab.TITLE_CUSTOMERS,
    unique: bool = False,
) -> DataFrame:
    """The fifteen curated columns: keep-first by ticket id, then one narrow projection.

    Repeated tickets go before the text work, so raw columns are shuffled, not the wider derived
    ones. Expressions used by several columns (text, type, server) are projected once, below.
    ``unique`` says that each ticket id comes once already; nothing is shuffled then.
    """
    require_columns(staging, schemas.REQUIRED["staging_tickets"])
    order = _order_of(staging)
    aligned = align_optional_columns(staging, schemas.STAGING_TICKETS, carry=TECHNICAL)
    valid = filter_valid_id(aligned, "id", "id_ticket")
    if not unique:
        valid = keep_first(valid, ["id_ticket"], order)
    subject, low, up = F.col("_text"), F.col("_low"), F.col("_up")
    derived = (
        valid.withColumn("_text", text.normalise_text(F.col("subject")))
        .withColumns({"_low": F.lower(subject), "_up": F.upper(subject)})
        .withColumns(
            {
                "_created": temporal.parse_timestamp(F.col("created_at")),
                "_updated": temporal.parse_timestamp(F.col("updated_at")),
                "tipo_ticket": text.classify_ticket(subject, lowered=low),
                "_server": text.logical_server(subject, lowered=low),
            }
        )
    )
    kind = F.col("tipo_ticket")
    created, updated = F.col("_created"), F.col("_updated")
    curated = derived.withColumns(
        {
            "empresa": text.map_company(F.col("company_id"), subject, codes, patterns),
            "data_criacao": F.date_format(created, "yyyy-MM-dd"),
            "data_ultima_alteracao": F.date_format(updated, "yyyy-MM-dd"),
            "status_ticket": text.map_status(F.col("status")),
            "foi_atuado": temporal.acted_flag(created, updated),
            "titulo_ticket": text.clean_title(subject, kind, title_customers, trimmed=True),
            "csi_status": text.csi_status_gate(quoted("custom_fields.cf_csi_status"), kind),
            "sgdb": text.detect_dbms(quoted("custom_fields.cf_sgdb"), subject, uppered=up),
            "ambiente": text.normalise_environment(quoted("custom_fields.cf_ambiente")),
            "nome_servidor": F.col("_server.nome_servidor"),
            "instancia": F.col("_server.instancia"),
            "nk_servidor": text.normalise_key(F.col("_server.nome_servidor")),
            "tempo_resolucao_horas": temporal.resolution_hours(created, updated),
        }
    )
    return _curated_columns(curated, schemas.CURATED_TICKETS.names)


def build_curated_tickets_legacy(
    staging: DataFrame,
    names: Mapping[int, str] = vocab.CUSTOMER_NAMES_LEGACY,
    aliases: Mapping[str, str] = vocab.CUSTOMER_ALIASES_LEGACY,
    title_customers: Sequence[str] = vocab.TITLE_CUSTOMERS_LEGACY,
) -> DataFrame:
    """The nine columns of the legacy generation; every text column is filled."""
    require_columns(staging, schemas.REQUIRED["staging_tickets_legacy"])
    order = _order_of(staging)
    status = F.col("status")
    coded = status.isNull() | status.try_cast("bigint").isNotNull()
    present = set(staging.columns)
    null_text = F.lit(None).cast("string")
    subject = F.col("subject") if "subject" in present else null_text
    declared = F.col("type") if "type" in present else null_text
    csi = quoted("custom_fields.cf_csi_status") if "custom_fields.cf_csi_status" in present else None
    valid = keep_first(filter_valid_id(staging, "id", "id_ticket"), ["id_ticket"], order)
    derived = valid.withColumns(
        {
            "_created": temporal.parse_timestamp(F.col("created_at")),
            "_updated": temporal.parse_timestamp(F.col("updated_at")),
            "tipo_ticket": text.classify_ticket_legacy(declared, subject),
        }
    )
    kind = F.col("tipo_ticket")
    created, updated = F.col("_created"), F.col("_updated")
    gate = (
        text.csi_status_gate(null_text, kind) if csi is None
        else text.csi_status_gate_legacy(csi, kind)
    )
    company = (
        text.map_company_legacy(F.col("company_id"), names, aliases)
        if "company_id" in present else F.lit("")
    )
    curated = derived.withColumns(
        {
            "empresa": company,
            "data_criacao": F.date_format(created, "yyyy-MM-dd"),
            "data_ultima_alteracao": F.date_format(updated, "yyyy-MM-dd"),
            "status_ticket": F.when(coded, text.map_status_legacy(status)).otherwise(text.map_status_legacy(status, numeric=False)),
            "foi_atuado": temporal.acted_flag(created, updated, negative="não"),
            "titulo_ticket": text.clean_title_legacy(subject, kind, title_customers),
            "csi_status": gate,
        }
    )
    filled = curated.withColumns(
        {c: text.normalise_text(F.col(c)) for c in schemas.CURATED_TICKETS_LEGACY.names if c != "id_ticket"}
    )
    return _curated_columns(filled, schemas.CURATED_TICKETS_LEGACY.names)


def _curated_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names, *[c for c in TECHNICAL if c in df.columns])
