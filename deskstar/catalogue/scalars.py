"""Text, time, number and map operators over tickets, feeds and prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar import bindings as b
from deskstar.catalogue import sql as q
from deskstar.catalogue.registry import query
from deskstar.functions import numeric, temporal, text
from deskstar.operators.joins import table_lookup
from deskstar.sources.raw import explode_items

C = F.col


def _tickets(spark: SparkSession, sf: str, **cols: Column) -> DataFrame:
    return b.ticket_events(spark, sf).select("id", *[c.alias(n) for n, c in cols.items()])


def _twin(**cols: str) -> str:
    body = ", ".join(f"{c} AS {n}" for n, c in cols.items())
    return q.with_ctes(f"SELECT id, {body} FROM bt")


def _prose_twin(**cols: str) -> str:
    body = ", ".join(f"{c} AS {n}" for n, c in cols.items())
    return q.with_ctes(f"SELECT origem, id, {body} FROM subj")


def _prose(spark: SparkSession, sf: str, **cols: Column) -> DataFrame:
    return b.prepared_subjects(spark, sf).select("origem", "id", *[c.alias(n) for n, c in cols.items()])


# --- text --------------------------------------------------------------------------------------------
# Full upper-casing doubles the sharp s; the twin's engine has a one-letter capital for it.
@query("normalise_text", _prose_twin(
    texto=q.text("subject"), minusculo=f"lower({q.text('subject')})",
    chave=q.collapse(f"replace(replace(upper({q.text('subject')}), 'ß', 'SS'), 'ẞ', 'SS')")))
def _(spark, sf):
    s = C("subject")
    return _prose(spark, sf, texto=text.normalise_text(s), minusculo=text.normalise_lower(s), chave=text.normalise_key(s))


@query("map_status", _twin(status_ticket=q.STATUS_SQL))
def _(spark, sf):
    return _tickets(spark, sf, status_ticket=text.map_status(C("status")))


@query("map_status_legacy", _twin(status_ticket=q.STATUS_LEGACY_SQL))
def _(spark, sf):
    return _tickets(spark, sf, status_ticket=text.map_status_legacy(C("status")))


@query("map_company", _twin(empresa=q.COMPANY_SQL))
def _(spark, sf):
    return _tickets(spark, sf, empresa=text.map_company(C("company_id"), C("subject"), b.CODES, b.PATTERNS))


@query("map_company_legacy", _twin(empresa=q.COMPANY_LEGACY_SQL))
def _(spark, sf):
    return _tickets(spark, sf, empresa=text.map_company_legacy(C("company_id"), b.NAMES_LEGACY, b.ALIASES_LEGACY))


@query("classify_ticket", _prose_twin(tipo_ticket=q.kind()))
def _(spark, sf):
    return _prose(spark, sf, tipo_ticket=text.classify_ticket(C("texto"), lowered=C("minusculo")))


@query("classify_ticket_legacy", _twin(tipo_ticket=q.kind_legacy()))
def _(spark, sf):
    return _tickets(spark, sf, tipo_ticket=text.classify_ticket_legacy(C("type"), C("subject")))


@query("clean_title", _prose_twin(titulo=q.title("subject", f"({q.kind()})")))
def _(spark, sf):
    kind = text.classify_ticket(C("texto"), lowered=C("minusculo"))
    title = text.clean_title(C("texto"), kind, tuple(b.CODES.values()), trimmed=True)
    return _prose(spark, sf, titulo=title)


@query("clean_title_legacy", _prose_twin(titulo=q.title_legacy("subject", f"({q.kind()})")))
def _(spark, sf):
    kind = text.classify_ticket(C("texto"), lowered=C("minusculo"))
    title = text.clean_title_legacy(C("texto"), kind, ("AAA", "BBB"), trimmed=True)
    return _prose(spark, sf, titulo=title)


@query("csi_status_gate", _twin(
    csi_status=q.csi_gate("cf_csi_status", f"({q.kind()})"),
    csi_status_legado=f"CASE WHEN ({q.kind()}) = 'CSI' AND cf_csi_status IS NOT NULL THEN lower({q.text('cf_csi_status')}) ELSE 'na' END"))
def _(spark, sf):
    kind = text.classify_ticket(C("subject"))
    return _tickets(
        spark, sf, csi_status=text.csi_status_gate(C("cf_csi_status"), kind),
        csi_status_legado=text.csi_status_gate_legacy(C("cf_csi_status"), kind),
    )


@query("detect_dbms", _twin(sgdb=q.dbms("cf_sgdb", "subject")))
def _(spark, sf):
    return _tickets(spark, sf, sgdb=text.detect_dbms(C("cf_sgdb"), C("subject")))


@query("normalise_environment", _twin(ambiente=q.environment("cf_ambiente")))
def _(spark, sf):
    return _tickets(spark, sf, ambiente=text.normalise_environment(C("cf_ambiente")))


@query("environment_macro", _twin(
    direto=q.macro("cf_ambiente"), normalizado=q.macro(f"({q.environment('cf_ambiente')})")))
def _(spark, sf):
    raw = C("cf_ambiente")
    return _tickets(
        spark, sf, direto=text.environment_macro(raw),
        normalizado=text.environment_macro(text.normalise_environment(raw)),
    )


@query("extract_instance", _prose_twin(instancia=q.instance("subject")))
def _(spark, sf):
    return _prose(spark, sf, instancia=text.extract_instance(C("texto"), trimmed=True))


@query("extract_server", _prose_twin(servidor=q.server("subject")))
def _(spark, sf):
    return _prose(spark, sf, servidor=text.extract_server(C("texto"), lowered=C("minusculo")))


@query("logical_server", q.with_ctes(
    f"SELECT origem, id, CASE WHEN s <> '' THEN s ELSE i END AS nome_servidor, i AS instancia, "
    f"{q.collapse('upper(CASE WHEN s <> ' + chr(39) * 2 + ' THEN s ELSE i END)')} AS nk_servidor FROM x",
    x=f"SELECT origem, id, {q.server('subject')} AS s, {q.instance('subject')} AS i FROM subj"))
def _(spark, sf):
    found = _prose(spark, sf, l=text.logical_server(C("texto"), lowered=C("minusculo")))
    return found.select("origem", "id", "l.*", text.normalise_key(C("l.nome_servidor")).alias("nk_servidor"))


@query("server_natural_key",
       "SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN 'HOST A' ELSE upper(s_name) END AS nk_servidor FROM supplier")
def _(spark, sf):
    host = F.when(C("s_nationkey") % 3 == 0, "  host   a ").when(C("s_nationkey") % 3 == 1, " ")
    return b.table(spark, sf, "supplier").select(
        "s_suppkey", text.server_natural_key(host, C("s_name")).alias("nk_servidor"))


@query("combine_first", _twin(
    ambiente="coalesce(cf_ambiente, cf_sgdb, subject)", alterado_em="CAST(coalesce(updated_at, created_at) AS TIMESTAMP)"))
def _(spark, sf):
    return _tickets(
        spark, sf, ambiente=text.combine_first(C("cf_ambiente"), C("cf_sgdb"), C("subject")),
        alterado_em=text.combine_first(C("updated_at"), C("created_at")).cast("timestamp_ntz"),
    )


@query("blank_to_default", _twin(
    com_padrao="CASE WHEN " + q.text("cf_csi_status") + " = '' THEN 'NÃO IDENTIFICADO' ELSE " + q.text("cf_csi_status") + " END",
    sem_nulo=q.text("cf_csi_status"), sem_branco=f"nullif({q.text('cf_csi_status')}, '')"))
def _(spark, sf):
    c = C("cf_csi_status")
    return _tickets(
        spark, sf, com_padrao=text.blank_to_default(c, "NÃO IDENTIFICADO"),
        sem_nulo=text.blank_to_default(c, ""), sem_branco=text.blank_to_default(c, None),
    )


def _dictionary(spark: SparkSession, entries: dict, key: str):
    return spark.createDataFrame(list(entries.items()), f"codigo {key}, nome string")


@query("map_company_tables", _twin(empresa=q.COMPANY_SQL))
def _(spark, sf):
    """Customers out of a table instead of literals."""
    tickets = b.ticket_events(spark, sf).select("id", "company_id", "subject")
    named = table_lookup(tickets, C("company_id"), _dictionary(spark, b.CODES, "bigint"), "codigo_cliente", ["id"])
    return named.select("id", text.company_from(C("codigo_cliente"), C("subject"), b.PATTERNS).alias("empresa"))


@query("map_company_legacy_tables", _twin(empresa=q.COMPANY_LEGACY_SQL))
def _(spark, sf):
    """Names and their aliases out of two tables."""
    tickets = b.ticket_events(spark, sf).select("id", "company_id")
    named = table_lookup(tickets, C("company_id"), _dictionary(spark, b.NAMES_LEGACY, "bigint"), "nome", ["id"])
    aliases = _dictionary(spark, b.ALIASES_LEGACY, "string")
    return table_lookup(named, F.upper(text.strip(C("nome"))), aliases, "empresa", ["id"], "").select("id", "empresa")


@query("dict_lookup_table", """SELECT o_orderkey, coalesce(c_name, '?') AS cliente FROM orders LEFT JOIN customer
    ON c_custkey = CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN -o_custkey ELSE o_custkey END""")
def _(spark, sf):
    """A dictionary that grows with the data; a fifth of the codes is NULL and a fifth is unknown."""
    part = C("o_orderkey") % 5
    code = F.when(part == 0, F.lit(None)).when(part == 1, -C("o_custkey")).otherwise(C("o_custkey"))
    names = b.table(spark, sf, "customer").select("c_custkey", "c_name")
    found = table_lookup(b.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), code, names, "cliente", ["o_orderkey"], "?")
    return found.select("o_orderkey", "cliente")


@query("dict_lookup", _twin(
    status=q.case("status", q.STATUS, "NULL"), prioridade="CASE priority WHEN 1 THEN 'Baixa' WHEN 2 THEN 'Média' WHEN 3 THEN 'Alta' ELSE '?' END"))
def _(spark, sf):
    priorities = {1: "Baixa", 2: "Média", 3: "Alta"}
    return _tickets(
        spark, sf, status=text.dict_lookup(q.STATUS, C("status")),
        prioridade=text.dict_lookup(priorities, C("priority"), F.lit("?")),
    )


# --- dates -------------------------------------------------------------------------------------------
@query("normalise_date", _twin(
    data_criacao="strftime(created_at, '%Y-%m-%d')", data_ultima_alteracao="strftime(updated_at, '%Y-%m-%d')", invalida="CAST(NULL AS VARCHAR)"))
def _(spark, sf):
    return b.raw_pages(spark, sf).where("page = 1").select(
        "id", temporal.normalise_date(C("created_at")).alias("data_criacao"),
        temporal.normalise_date(C("updated_at")).alias("data_ultima_alteracao"),
        temporal.normalise_date(F.concat(F.lit("x"), C("created_at"))).alias("invalida"),
    )


@query("resolution_hours", _twin(tempo_resolucao_horas=q.hours("created_at", "updated_at")))
def _(spark, sf):
    return _tickets(spark, sf, tempo_resolucao_horas=temporal.resolution_hours(C("created_at"), C("updated_at")))


@query("acted_flag", _twin(
    foi_atuado="CASE WHEN updated_at > created_at THEN 'sim' ELSE 'nao' END",
    foi_atuado_legado="CASE WHEN updated_at > created_at THEN 'sim' ELSE 'não' END"))
def _(spark, sf):
    c, u = C("created_at"), C("updated_at")
    return _tickets(
        spark, sf, foi_atuado=temporal.acted_flag(c, u), foi_atuado_legado=temporal.acted_flag(c, u, "não"))


@query("flag_to_int", _twin(
    flag="CAST(CASE WHEN updated_at > created_at THEN 1 WHEN updated_at IS NOT NULL THEN 0 END AS SMALLINT)"))
def _(spark, sf):
    spelled = F.when(C("updated_at") > C("created_at"), "SIM").when(C("updated_at").isNull(), "talvez").when(
        C("id") % 2 == 0, "Não").otherwise("nao")
    return _tickets(spark, sf, flag=temporal.flag_to_int(spelled))


@query("parse_month", """SELECT mes, CAST(count(*) AS BIGINT) AS linhas, anomes FROM (SELECT
    CASE WHEN l_linenumber = 7 THEN '13/2026' WHEN l_linenumber = 6 THEN ' ' ELSE month(l_shipdate) || '/' || year(l_shipdate) END AS mes,
    CASE WHEN l_linenumber < 6 THEN CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) END AS anomes FROM lineitem) GROUP BY ALL""")
def _(spark, sf):
    day = C("l_shipdate")
    month = F.concat_ws("/", F.month(day), F.year(day))
    mes = F.when(C("l_linenumber") == 7, "13/2026").when(C("l_linenumber") == 6, " ").otherwise(month)
    months = b.table(spark, sf, "lineitem").groupBy(mes.alias("mes")).agg(F.count(F.lit(1)).alias("linhas"))
    return months.withColumn("anomes", temporal.parse_month(C("mes")))


@query("yyyymm_to_date", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber < 7 THEN
    CAST(date_trunc('month', l_shipdate) AS DATE) END AS data_referencia FROM lineitem""")
def _(spark, sf):
    anomes = F.when(C("l_linenumber") == 7, F.lit(202613)).otherwise(temporal.month_key(C("l_shipdate")))
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", temporal.yyyymm_to_date(anomes).alias("data_referencia"))


@query("normalise_number", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS valor,
    CASE WHEN o_orderpriority LIKE '1%' THEN CAST(NULL AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS cliente FROM orders""")
def _(spark, sf):
    price = F.when(C("o_orderstatus") == "F", "1.234,56").otherwise(F.concat(F.lit(" "), C("o_totalprice").cast("string")))
    client = F.when(C("o_orderpriority").startswith("1"), " ").otherwise(
        F.concat(C("o_custkey").cast("string"), F.lit(" ")))
    return b.table(spark, sf, "orders").select(
        "o_orderkey", numeric.normalise_number(price).alias("valor"), numeric.normalise_number(client).alias("cliente"))


@query("coerce_numeric", """SELECT event_id, CAST(NULL AS DOUBLE) AS event_type, value,
    CAST(user_id AS DOUBLE) AS user_id FROM events""")
def _(spark, sf):
    events = b.table(spark, sf, "events").select("event_id", "event_type", "value", C("user_id").cast("string").alias("user_id"))
    return numeric.coerce_numeric(events, ["event_type", "value", "user_id"])


@query("calendar_attributes", """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_tempo, d AS data_completa, CAST(year(d) AS SMALLINT) AS ano,
    CAST(month(d) AS SMALLINT) AS mes, CAST(day(d) AS SMALLINT) AS dia, CAST(strftime(d, '%Y%m') AS INTEGER) AS anomes,
    CASE month(d) WHEN 1 THEN 'Janeiro' WHEN 2 THEN 'Fevereiro' WHEN 3 THEN 'Março' WHEN 4 THEN 'Abril' WHEN 5 THEN 'Maio' WHEN 6 THEN 'Junho'
    WHEN 7 THEN 'Julho' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Setembro' WHEN 10 THEN 'Outubro' WHEN 11 THEN 'Novembro' ELSE 'Dezembro' END AS nome_mes,
    CAST((month(d) + 2) // 3 AS SMALLINT) AS trimestre, CAST(CASE WHEN month(d) < 7 THEN 1 ELSE 2 END AS SMALLINT) AS semestre
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(spark, sf):
    days = b.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("data_completa")).distinct()
    return temporal.calendar_attributes(days)


# --- labels and arrays --------------------------------------------------------------------------------
@query("case_buckets", q.with_ctes("""SELECT instancia, anomes, CASE WHEN disponibilidade_pct < 98 THEN 'Crítico'
    WHEN disponibilidade_pct < 99 THEN 'Atenção' ELSE 'Normal' END AS status_disponibilidade,
    CASE WHEN delta_1_mes > 100 THEN 'Crescimento elevado' WHEN delta_1_mes > 50 THEN 'Crescimento moderado'
    ELSE 'Crescimento normal' END AS status_capacity FROM srv_staging"""))
def _(spark, sf):
    labelled = numeric.case_buckets(b.staging_servers(spark, sf), "DISPONIBILIDADE_PCT", "DELTA_1_MES")
    return labelled.select(
        C("INSTANCIA").alias("instancia"), C("ANOMES").alias("anomes"), "status_disponibilidade", "status_capacity")


@query("explode_items", """SELECT doc_id, lang, CAST(pos - 1 AS INTEGER) AS pos, linha, CAST(length(linha) AS INTEGER) AS tamanho FROM (
    SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS linha, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)""")
def _(spark, sf):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("linha"), F.length(x).alias("tamanho")))
    docs = b.table(spark, sf, "documents").select("doc_id", "lang", lines.alias("items"))
    return explode_items(docs, C("items"), keep=["doc_id", "lang"])
