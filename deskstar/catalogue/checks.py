"""Profiles and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskstar import bindings as b
from deskstar import schemas, vocab
from deskstar.catalogue import sql as q
from deskstar.catalogue.lake import _RAW, undotted
from deskstar.catalogue.registry import query
from deskstar.functions import temporal, text
from deskstar.operators import quality
from deskstar.plans import facts
from deskstar.sources.contracts import lower_names

C = F.col


def _union(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _pct(part: str, total: str = "count(*)") -> str:
    return f"CAST(((2 * CAST({part} AS HUGEINT) * 10000 + {total}) // (2 * {total})) / 100.0 AS DECIMAL(5,2))"


@query("null_profile", q.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS coluna, count(*) AS linhas, {_pct(f'(count(*) - count({c}))')} AS pct_nulos FROM bt"
    for c in ("id", "subject", "status", "type", "updated_at", "cf_sgdb", "cf_ambiente", "cf_csi_status"))))
def _(spark, sf):
    tickets = b.ticket_events(spark, sf).select(
        "id", "subject", "status", "type", "updated_at", "cf_sgdb", "cf_ambiente", "cf_csi_status")
    return quality.null_profile(tickets)


@query("duplicate_count", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicados FROM lineitem")
def _(spark, sf):
    return quality.duplicate_count(b.table(spark, sf, "lineitem"), "l_orderkey")


# Stored column behind each audited one.
MAPPING = {
    ("fato_tickets", "ticket_id"): "id_ticket_origem",
    ("fato_tickets", "sk_tempo_abertura"): "sk_tempo_criacao",
    ("fato_tickets", "sk_tempo_encerramento"): "sk_tempo_ultima_alt",
    ("fato_tickets", "sk_status"): "sk_status_ticket",
    ("fato_servidor", "disponibilidade_percentual"): "disponibilidade_pct",
    ("fato_servidor", "espaco_total_gb"): "tamanho_gb",
    ("fato_servidor", "crescimento_diario_gb"): "delta_1_dia",
    ("fato_csi", "sk_csi"): "sk_fato_csi",
    ("fato_csi", "sk_status"): "sk_status_csi",
}


def _measured(column: str, table: str) -> str:
    return f"(SELECT CASE WHEN count({column}) < count(*) THEN 'PARCIAL' ELSE 'OK' END FROM {table})"


def _lineage_twin() -> str:
    fact = {"fato_tickets": "fato_ticket", "fato_servidor": "fato_servidor", "fato_csi": "fato_csi"}
    absent = {"sk_prioridade", "sk_classificacao", "espaco_usado_gb", "espaco_livre_gb", "crescimento_diario_gb"}
    rows = []
    for table, column, declared in vocab.TRACEABILITY:
        stored = MAPPING.get((table, column), column)
        if column in absent:
            measured = "'NAO_ATENDIDO'"
        elif stored == "sk_fato_csi":
            measured = "'OK'"
        else:
            measured = _measured(stored, fact[table])
        rows.append(f"SELECT '{table}' AS t, '{declared}' AS d, {measured} AS m")
    return q.with_ctes(
        "SELECT t AS tabela_dw, m AS status, count(*) AS colunas, count(*) FILTER (m <> d) AS divergentes FROM "
        f"({' UNION ALL '.join(rows)}) GROUP BY 1, 2")


@query("lineage_coverage", _lineage_twin())
def _(spark, sf):
    wh = b.star(spark, sf).warehouse
    tables = {"fato_tickets": wh.read("fato_ticket"), "fato_servidor": wh.read("fato_servidor"), "fato_csi": wh.read("fato_csi")}
    return quality.lineage_coverage(quality.measured_status(spark, tables, mapping=MAPPING))


# --- periods and keys ---------------------------------------------------------------------------------------
@query("reject_invalid_period", """SELECT CASE WHEN l_linenumber = 7 THEN 202613 ELSE CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) END AS anomes,
    CASE WHEN l_linenumber = 7 THEN 'recusada' ELSE 'aceita' END AS situacao, count(*) AS linhas FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    month = F.when(C("l_linenumber") == 7, F.lit(202613)).otherwise(temporal.month_key(C("l_shipdate")))
    rows = b.table(spark, sf, "lineitem").select(month.alias("anomes"))
    dated = rows.withColumn("periodo", temporal.yyyymm_to_date(C("anomes")))
    good = quality.reject_invalid_period(dated, "periodo", "anomes", mode="quarantine")
    _, bad = quality.split_invalid_period(dated, "periodo")
    labelled = good.withColumn("situacao", F.lit("aceita")).unionByName(bad.withColumn("situacao", F.lit("recusada")))
    return labelled.groupBy("anomes", "situacao").agg(F.count(F.lit(1)).alias("linhas"))


@query("require_unique_key", """SELECT l_orderkey, l_linenumber, count(*) AS linhas FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, sf):
    quality.require_unique_key(b.table(spark, sf, "orders"), ["o_orderkey"])
    return quality.repeated_keys(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("require_resolved_sk", q.with_ctes("""SELECT 'sk_status_csi' AS chave, 'csi_status' AS origem, count(*) FILTER (csi_status = '') AS nao_resolvidas,
    count(*) FILTER (csi_status <> '') AS aceitas FROM curated WHERE tipo_ticket = 'CSI'
    UNION ALL SELECT 'sk_tempo_criacao', 'data_criacao', 0, count(*) FILTER (csi_status <> '') FROM curated WHERE tipo_ticket = 'CSI'"""))
def _(spark, sf):
    st = b.star(spark, sf)
    fact = facts.csi_fact(st.warehouse, st.curated)
    good, _ = quality.require_resolved_sk(fact, facts.CSI_MANDATORY, "quarantine")
    accepted = good.agg(F.count(F.lit(1)).alias("aceitas"))
    return quality.unresolved_counts(fact, facts.CSI_MANDATORY).withColumn("aceitas", accepted.scalar())


# --- constraints ---------------------------------------------------------------------------------------------
def _unchecked(spark, sf):
    """Rows as they would be without the guards of the refine step."""
    micros = F.unix_micros("updated_at") - F.unix_micros("created_at")
    tickets = b.ticket_events(spark, sf).select((micros / 3_600_000_000).alias("tempo_resolucao_horas"), "cf_ambiente")
    servers = lower_names(b.availability(spark, sf)).withColumn("disponibilidade_pct", C("disponibilidade_pct") + 2)
    return {
        "fato_ticket": tickets, "fato_csi": tickets.where("cf_ambiente = 'qa'"), "fato_servidor": servers,
        "dim_servidor": tickets.select(text.normalise_environment(C("cf_ambiente")).alias("ambiente_macro")),
    }


@query("check_constraints", q.with_ctes("""SELECT 'fato_ticket' AS tabela, 'hours_not_negative' AS regra, count(*) FILTER (updated_at < created_at) AS violacoes FROM bt
    UNION ALL SELECT 'fato_csi', 'hours_not_negative', count(*) FILTER (updated_at < created_at AND cf_ambiente = 'qa') FROM bt
    UNION ALL SELECT 'fato_servidor', 'availability_is_percentage', count(*) FILTER (disponibilidade_pct + 2 > 100) FROM disp
    UNION ALL SELECT 'dim_servidor', 'macro_environment_domain', count(*) FILTER (cf_ambiente IS NULL OR cf_ambiente <> 'prd') FROM bt"""))
def _(spark, sf):
    return quality.check_constraints(_unchecked(spark, sf))


@query("check_unique", """SELECT 'lineitem' AS tabela, 'l_orderkey,l_linenumber' AS chave, count(*) AS chaves_repetidas, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS linhas_excedentes
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1
    UNION ALL SELECT 'events', 'user_id', count(*), CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM events GROUP BY user_id) WHERE n > 1
    UNION ALL SELECT 'orders', 'o_orderkey', count(*), CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) WHERE n > 1""")
def _(spark, sf):
    uniques = {"lineitem": ("l_orderkey", "l_linenumber"), "events": ("user_id",), "orders": ("o_orderkey",)}
    return quality.check_unique({t: b.table(spark, sf, t) for t in uniques}, uniques)


@query("check_foreign_keys", """SELECT 'orders' AS tabela, 'o_custkey' AS coluna, 'customer' AS dimensao,
      CAST(count(*) FILTER (o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)) AS BIGINT) AS orfaos, CAST(0 AS BIGINT) AS nulos_indevidos FROM orders
    UNION ALL SELECT 'lineitem', 'l_partkey', 'part', count(*) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part)), 0 FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_suppkey', 'supplier', count(*) FILTER (l_suppkey NOT IN (SELECT s_suppkey FROM supplier)), 0 FROM lineitem
    UNION ALL SELECT 'documents', 'doc_id', 'labels', count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)), 0 FROM documents
    UNION ALL SELECT 'documents', 'anotado', 'labels', 0, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) FROM documents""")
def _(spark, sf):
    keys = {
        "orders": (("o_custkey", "customer", False),),
        "lineitem": (("l_partkey", "part", False), ("l_suppkey", "supplier", False)),
        "documents": (("doc_id", "labels", False), ("anotado", "labels", False)),
    }
    parents = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "labels": "doc_id"}
    names = {*keys, *parents}
    tables = {t: b.table(spark, sf, t) for t in names}
    known = tables["labels"].select(C("doc_id").alias("anotado")).distinct()
    docs = tables["documents"].select("doc_id")
    tables["documents"] = docs.join(known, C("doc_id") == C("anotado"), "left")
    return quality.check_foreign_keys(tables, keys, parents)


@query("star_foreign_keys", q.with_ctes("SELECT CAST(14 AS BIGINT) AS chaves, CAST(0 AS BIGINT) AS orfaos, CAST(0 AS BIGINT) AS nulos_indevidos, count(*) AS tickets FROM fato_ticket"))
def _(spark, sf):
    wh = b.star(spark, sf).warehouse
    found = quality.check_foreign_keys({t: wh.read(t) for t in schemas.STAR_TABLES})
    tickets = wh.read("fato_ticket").agg(F.count(F.lit(1))).scalar()
    return found.agg(
        F.count(F.lit(1)).alias("chaves"), F.sum("orfaos").alias("orfaos"), F.sum("nulos_indevidos").alias("nulos_indevidos"),
    ).withColumn("tickets", tickets)


# --- domains and layers ----------------------------------------------------------------------------------------
@query("domain_check", q.with_ctes("""SELECT 'tipo_ticket' AS coluna, tipo_ticket AS valor, count(*) AS linhas FROM curated
    WHERE tipo_ticket NOT IN ('Checklist', 'Incidente', 'CSI', 'Crise', 'Outro') GROUP BY 2
    UNION ALL SELECT 'status_ticket', status_ticket, count(*) FROM curated WHERE status_ticket NOT IN
    ('Aberto', 'Em Execução', 'Aguardando o cliente', 'Resolvido', 'Fechado', 'Encerrado') GROUP BY 2
    UNION ALL SELECT 'lang', lang, count(*) FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 2"""))
def _(spark, sf):
    curated = b.star(spark, sf).curated
    return _union([
        quality.domain_check(curated, "tipo_ticket", vocab.AUDIT_DOMAINS["tipo_ticket"]),
        quality.domain_check(curated, "status_ticket", vocab.AUDIT_DOMAINS["status"]),
        quality.domain_check(b.table(spark, sf, "documents"), "lang", ("en", "fr")),
    ])


@query("dw_conformity", q.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS coluna, 'OK' AS situacao, {_pct(f'(count(*) - count({c}))')} AS pct_nulos FROM curated"
    if c in ("tipo_ticket", "tempo_resolucao_horas", "sgdb")
    else f"SELECT '{c}' AS coluna, 'FALTANDO' AS situacao, CAST(NULL AS DECIMAL(5,2)) AS pct_nulos" for c in vocab.AUDIT_COLUMNS)))
def _(spark, sf):
    return quality.dw_conformity(b.star(spark, sf).curated)


@query("layer_reconciliation", """SELECT 'linhas_staging' AS medida, count(*) AS valor FROM documents UNION ALL SELECT 'linhas_curated', count(*) FROM labels
    UNION ALL SELECT 'ids_apenas_staging', count(*) FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    UNION ALL SELECT 'ids_apenas_curated', count(*) FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))""")
def _(spark, sf):
    return quality.layer_reconciliation(b.table(spark, sf, "documents"), b.table(spark, sf, "labels"), "doc_id", "doc_id")


_AUDITED = [f.name.replace(".", "__") for f in schemas.STAGING_TICKETS.fields]


def _profile(part: str, table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{part}' AS parte, '{c}' AS item, 'linhas' AS medida, CAST(count(*) AS DECIMAL(20,2)) AS valor FROM {table} "
        f"UNION ALL SELECT '{part}', '{c}', 'pct_nulos', CAST({_pct(f'(count(*) - count({c}))')} AS DECIMAL(20,2)) FROM {table}"
        for c in columns)


_CONFORMITY = " UNION ALL ".join(
    f"SELECT 'conformidade', '{c}|OK', 'pct_nulos', CAST({_pct(f'(count(*) - count({c}))')} AS DECIMAL(20,2)) FROM curated"
    if c in schemas.CURATED_TICKETS.names else f"SELECT 'conformidade', '{c}|FALTANDO', 'pct_nulos', NULL" for c in vocab.AUDIT_COLUMNS)


@query("audit_report", q.with_ctes(f"""SELECT parte, item, medida, CAST(valor AS DECIMAL(20,2)) AS valor FROM ({_profile("perfil_staging", f"(SELECT {_RAW} FROM bt)", _AUDITED)}
    UNION ALL {_profile("perfil_curated", "curated", schemas.CURATED_TICKETS.names)} UNION ALL {_CONFORMITY}
    UNION ALL SELECT 'duplicados_staging', '', 'duplicados', count(*) - count(DISTINCT id) FROM bt
    UNION ALL SELECT 'duplicados_curated', '', 'duplicados', count(*) - count(DISTINCT id_ticket) FROM curated
    UNION ALL SELECT 'reconciliacao', 'linhas_staging', 'valor', count(*) FROM bt
    UNION ALL SELECT 'reconciliacao', 'linhas_curated', 'valor', count(*) FROM curated
    UNION ALL SELECT 'reconciliacao', 'ids_apenas_staging', 'valor', count(DISTINCT id) FROM bt WHERE CAST(id AS VARCHAR) NOT IN (SELECT CAST(id_ticket AS VARCHAR) FROM curated)
    UNION ALL SELECT 'reconciliacao', 'ids_apenas_curated', 'valor', count(DISTINCT id_ticket) FROM curated WHERE CAST(id_ticket AS VARCHAR) NOT IN (SELECT CAST(id AS VARCHAR) FROM bt)
    UNION ALL SELECT DISTINCT 'diferenca', id || '|staging', 'linhas', 1 FROM bt WHERE CAST(id AS VARCHAR) NOT IN (SELECT CAST(id_ticket AS VARCHAR) FROM curated)
    UNION ALL SELECT DISTINCT 'diferenca', id_ticket || '|curated', 'linhas', 1 FROM curated WHERE CAST(id_ticket AS VARCHAR) NOT IN (SELECT CAST(id AS VARCHAR) FROM bt)
    UNION ALL SELECT 'dominio_tipo_ticket', 'tipo_ticket|' || tipo_ticket, 'linhas', count(*) FROM curated
    WHERE tipo_ticket NOT IN ('Checklist', 'Incidente', 'CSI', 'Crise', 'Outro') GROUP BY tipo_ticket) audit"""))
def _(spark, sf):
    """The whole audit of both ticket layers."""
    star = b.star(spark, sf)
    staging = undotted(star.staging.select(*[f"`{f.name}`" for f in schemas.STAGING_TICKETS.fields]))
    return quality.audit_rows(quality.audit_report(staging, star.curated.select(*schemas.CURATED_TICKETS.names)))
