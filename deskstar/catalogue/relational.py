"""Joins, aggregations, de-duplication, order and write semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskstar import bindings as b
from deskstar.catalogue import sql as q
from deskstar.catalogue.registry import query
from deskstar.functions import temporal, text
from deskstar.operators import capacity, dedupe, joins, keys, members, quality, upserts
from deskstar.plans import dimensions, marts
from deskstar.plans.refine import build_curated_tickets_legacy, order_staging_desc_nulls_last
from deskstar.session import fresh_path
from deskstar.sources.contracts import lower_names
from deskstar.sources.warehouse import Warehouse

C = F.col

SERVER_COLS = ("instancia", "host_name", "anomes", "tamanho_gb", "delta_1_mes", "delta_2_meses", "delta_3_meses",
               "delta_6_meses", "delta_12_meses", "disponibilidade_pct", "minutos_indisponiveis")


def _warehouse(spark) -> Warehouse:
    return Warehouse(spark, fresh_path(spark, "dw"))


# --- joins -------------------------------------------------------------------------------------------
@query("merge_outer_one_to_one", q.with_ctes("""SELECT coalesce(v.instancia, d.instancia) AS instancia, coalesce(v.anomes, d.anomes) AS anomes,
    v.tamanho_gb, d.disponibilidade_pct, d.minutos_indisponiveis FROM sz v FULL JOIN disp d USING (instancia, anomes)"""))
def _(spark, sf):
    feed = b.availability(spark, sf).drop("HOST_NAME")
    return lower_names(joins.merge_outer_one_to_one(b.sizes(spark, sf), feed, ["INSTANCIA", "ANOMES"]))


@query("lookup_sk", q.with_ctes("""SELECT id_ticket, c.nm_cliente, t.nm_tipo_ticket, s.nk_servidor FROM curated q
    LEFT JOIN dim_cliente c ON c.nm_cliente = q.empresa LEFT JOIN dim_tipo_ticket t ON t.nm_tipo_ticket = q.tipo_ticket
    LEFT JOIN dim_servidor s ON s.nk_servidor = q.nk_servidor"""))
def _(spark, sf):
    st = b.star(spark, sf)
    df = st.curated.select("id_ticket", "empresa", "tipo_ticket", "nk_servidor")
    used = {"dim_cliente": "empresa", "dim_tipo_ticket": "tipo_ticket", "dim_servidor": "nk_servidor"}
    for table, source in used.items():
        dim = st.warehouse.read_dimension(table)
        sk, nk = dim.columns
        df = joins.lookup_sk(df, dim, source, nk, ["id_ticket"]).drop(source)
        # Surrogate keys are arbitrary, so the result shows the name each one stands for.
        df = joins.left_lookup(df, dim.withColumnRenamed(sk, "_sk"), [(sk, "_sk")], ["id_ticket"]).drop(sk)
    return df.select("id_ticket", "nm_cliente", "nm_tipo_ticket", "nk_servidor")


@query("lookup_sk_casefold", q.with_ctes(f"""SELECT a.id, m.sk FROM bt a LEFT JOIN (SELECT lower({q.strip('cf_csi_status')}) AS nm, min(id) AS sk
    FROM bt WHERE cf_csi_status IS NOT NULL GROUP BY 1) m ON m.nm = lower({q.strip('a.cf_csi_status')})"""))
def _(spark, sf):
    tickets = b.ticket_events(spark, sf).select("id", "cf_csi_status")
    dim = tickets.where("cf_csi_status IS NOT NULL").groupBy(
        F.upper(text.strip(C("cf_csi_status"))).alias("nm")).agg(F.min("id").alias("sk"))
    return joins.lookup_sk_casefold(tickets, dim, "cf_csi_status", "nm", ["id"]).select("id", "sk")


@query("role_playing_dates", q.with_ctes("""SELECT id_ticket, d1.sk_tempo AS sk_tempo_criacao, d2.sk_tempo AS sk_tempo_ultima_alt FROM curated q
    LEFT JOIN dim_tempo d1 ON d1.data_completa = CAST(q.data_criacao AS DATE)
    LEFT JOIN dim_tempo d2 ON d2.data_completa = CAST(q.data_ultima_alteracao AS DATE)"""))
def _(spark, sf):
    st = b.star(spark, sf)
    days = st.curated.select(
        "id_ticket", temporal.to_day(C("data_criacao")).alias("c"), temporal.to_day(C("data_ultima_alteracao")).alias("u"))
    roles = {"c": "sk_tempo_criacao", "u": "sk_tempo_ultima_alt"}
    out = joins.role_playing_dates(days, st.ticket_dimensions.read_dimension("dim_tempo"), roles, ["id_ticket"])
    return out.select("id_ticket", "sk_tempo_criacao", "sk_tempo_ultima_alt")


@query("attach_client_to_server", q.with_ctes("""SELECT nk_servidor, c.nm_cliente FROM ticket_servers t
    LEFT JOIN dim_cliente c ON c.nm_cliente = t.empresa"""))
def _(spark, sf):
    st = b.star(spark, sf)
    clients = st.ticket_dimensions.read_dimension("dim_cliente")
    keyed = joins.attach_client_to_server(dimensions.server_members(st.curated), clients)
    return joins.left_lookup(
        keyed.select("nk_servidor", "sk_cliente"), clients.withColumnRenamed("sk_cliente", "_sk"),
        [("sk_cliente", "_sk")], ["nk_servidor"]).select("nk_servidor", "nm_cliente")


def _of(column: str, table: str, key: str, fact_key: str | None = None) -> str:
    """The attribute that a fact row ``f`` names by a key."""
    return f"(SELECT x.{column} FROM {table} x WHERE x.{key} = f.{fact_key or key}) AS {column}"


# Facts with names in place of keys. Month and day follow from the day key itself.
_DAY = """CAST(f.sk_tempo_criacao // 100 AS INTEGER) AS anomes,
    CAST(strptime(CAST(f.sk_tempo_criacao AS VARCHAR), '%Y%m%d') AS DATE) AS data_completa"""
_CLIENT, _KIND = _of("nm_cliente", "dim_cliente", "sk_cliente"), _of("nm_tipo_ticket", "dim_tipo_ticket", "sk_tipo_ticket")
_STATE = _of("nm_status_ticket", "dim_status_ticket", "sk_status_ticket")
_SERVER = "(SELECT x FROM dim_servidor x WHERE x.sk_servidor = f.sk_servidor) AS s"
_TICKETS = f"(SELECT f.*, {_DAY}, {_CLIENT}, {_KIND}, {_STATE}, {_SERVER} FROM fato_ticket f)"


def _ntz(df):
    return df.withColumn("data_carga", C("data_carga").cast("timestamp_ntz"))


_TECHNICAL = f"""SELECT anomes, data_completa, id_ticket_origem, nm_cliente, nm_tipo_ticket, nm_status_ticket, s.nk_servidor, s.nome_servidor,
    s.instancia, s.host_name, s.sgdb, s.ambiente, s.ambiente_macro, foi_atuado, tempo_resolucao_horas, titulo_ticket, data_carga FROM {_TICKETS}"""
TECHNICAL_SQL = q.with_ctes(_TECHNICAL)


@query("star_detail_left", TECHNICAL_SQL)
def _(spark, sf):
    return _ntz(marts.star_detail_left(b.star(spark, sf).warehouse))


_CSI = f"""SELECT anomes, id_ticket_origem, nm_cliente, s.nk_servidor, s.instancia, s.nome_servidor, nm_status_csi, titulo_csi, foi_atuado,
    tempo_resolucao_horas, data_carga FROM (SELECT f.*, {_DAY}, {_CLIENT}, {_of("nm_status_csi", "dim_status_csi", "sk_status_csi")}, {_SERVER} FROM fato_csi f)"""
CSI_SQL = q.with_ctes(_CSI)


@query("star_detail_csi", CSI_SQL)
def _(spark, sf):
    return _ntz(marts.star_detail_csi(b.star(spark, sf).warehouse))


_GRADE = "list_extract([{}], 1 + CAST(coalesce({} {}, false) AS INTEGER) + CAST(coalesce({} {}, false) AS INTEGER))"
_CAPACITY = f"""SELECT CAST(sk_tempo_referencia // 100 AS INTEGER) AS anomes, s.nk_servidor, s.instancia, s.host_name, s.nome_servidor, s.sgdb, s.ambiente,
    s.ambiente_macro, tamanho_gb, delta_1_mes, delta_3_meses, delta_6_meses, delta_12_meses, disponibilidade_pct, minutos_indisponiveis,
    {_GRADE.format("'Normal', 'Atenção', 'Crítico'", "disponibilidade_pct", "< 99", "disponibilidade_pct", "< 98")} AS status_disponibilidade,
    {_GRADE.format("'Crescimento normal', 'Crescimento moderado', 'Crescimento elevado'", "delta_1_mes", "> 50", "delta_1_mes", "> 100")} AS status_capacity
    FROM (SELECT f.*, {_SERVER} FROM fato_servidor f)"""
CAPACITY_SQL = q.with_ctes(_CAPACITY)


@query("star_detail_inner", CAPACITY_SQL)
def _(spark, sf):
    return marts.star_detail_inner(b.star(spark, sf).warehouse)


@query("calendar_two_fact_join", q.with_ctes("""SELECT dt.anomes, dt.sk_tempo % 100 AS dia, t.nm_cliente, t.tickets, t.checklists, t.csi, t.crises,
    t.acted, t.hours, s.servers, s.pct, s.minutos, s.gb FROM
    (SELECT sk_tempo_criacao AS k, nm_cliente, count(*) AS tickets, CAST(count(*) FILTER (nm_tipo_ticket = 'Checklist') AS BIGINT) AS checklists,
       CAST(count(*) FILTER (nm_tipo_ticket = 'CSI') AS BIGINT) AS csi, CAST(count(*) FILTER (nm_tipo_ticket = 'CRISE') AS BIGINT) AS crises,
       CAST(sum(foi_atuado) AS BIGINT) AS acted, CAST(sum(tempo_resolucao_horas) AS DECIMAL(38,2)) AS hours
     FROM fato_ticket f LEFT JOIN dim_cliente c ON c.sk_cliente = f.sk_cliente LEFT JOIN dim_tipo_ticket y ON y.sk_tipo_ticket = f.sk_tipo_ticket GROUP BY 1, 2) t
    FULL JOIN (SELECT sk_tempo_referencia AS k, count(*) AS servers, CAST(sum(disponibilidade_pct) AS DECIMAL(38,2)) AS pct,
       CAST(sum(minutos_indisponiveis) AS BIGINT) AS minutos, CAST(sum(tamanho_gb) AS DECIMAL(38,2)) AS gb FROM fato_servidor GROUP BY 1) s ON s.k = t.k
    JOIN dim_tempo dt ON dt.sk_tempo = coalesce(t.k, s.k)"""))
def _(spark, sf):
    df = marts.calendar_two_fact_join(b.star(spark, sf).warehouse)
    wide = {n: C(n).cast("decimal(38,2)") for n in ("hours", "pct", "tamanho_gb")}
    return df.withColumns({**wide, "dia": C("dia").cast("int")}).select(
        "anomes", "dia", "nm_cliente", "tickets", "checklists", "csi", "crises", "acted", "hours", "servers", "pct",
        C("minutos_indisponiveis").alias("minutos"), C("tamanho_gb").alias("gb"))


# Months of the physical server behind an instance; a ticket without any keeps one row.
_FULL = """SELECT t.anomes, data_completa, id_ticket_origem, nm_cliente, nm_tipo_ticket, nm_status_ticket, s.nk_servidor, s.instancia, s.host_name,
    s.sgdb, s.ambiente, foi_atuado, tempo_resolucao_horas, titulo_ticket, b.tamanho_gb, b.delta_1_mes, b.delta_3_meses, b.delta_6_meses,
    b.delta_12_meses, b.disponibilidade_pct, b.minutos_indisponiveis FROM {tickets} t
    LEFT JOIN (SELECT m.instancia, CAST(x.sk_tempo_referencia // 100 AS INTEGER) AS mes, x.* FROM fato_servidor x
      JOIN dim_servidor h USING (sk_servidor) JOIN map_servidor_instancia m ON m.host_name = h.host_name) b ON b.instancia = s.instancia{more}"""
_FULL_AS_IS, _FULL_MONTH = (_FULL.format(tickets=_TICKETS, more=more) for more in ("", " AND b.mes = t.anomes"))
FULL_TECHNICAL_SQL = q.with_ctes(_FULL_AS_IS)


@query("bridge_join", FULL_TECHNICAL_SQL)
def _(spark, sf):
    return marts.bridge_join(b.star(spark, sf).warehouse)


@query("bridge_join_fixed", q.with_ctes(_FULL_MONTH))
def _(spark, sf):
    return marts.bridge_join_fixed(b.star(spark, sf).warehouse)


@query("null_or_predicate", q.with_ctes("""SELECT dt.sk_tempo, t.tickets, s.servidores FROM dim_tempo dt
    LEFT JOIN (SELECT sk_tempo_criacao AS k, count(*) AS tickets FROM fato_ticket GROUP BY 1) t ON t.k = dt.sk_tempo
    LEFT JOIN (SELECT sk_tempo_referencia AS k, count(*) AS servidores FROM fato_servidor GROUP BY 1) s ON s.k = dt.sk_tempo
    WHERE t.tickets IS NOT NULL OR s.servidores IS NOT NULL"""))
def _(spark, sf):
    wh = b.star(spark, sf).warehouse
    tickets = wh.read("fato_ticket").groupBy(C("sk_tempo_criacao").alias("sk_tempo")).agg(F.count(F.lit(1)).alias("tickets"))
    servers = wh.read("fato_servidor").groupBy(C("sk_tempo_referencia").alias("sk_tempo")).agg(F.count(F.lit(1)).alias("servidores"))
    both = wh.read("dim_tempo").select("sk_tempo").join(tickets, "sk_tempo", "left").join(servers, "sk_tempo", "left")
    return joins.null_or_predicate(both, "tickets", "servidores")


@query("anti_new_members", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    known = b.table(spark, sf, "labels").select("doc_id")
    return joins.anti_new_members(b.table(spark, sf, "documents").select("doc_id", "lang"), known, ["doc_id"])


@query("semi_delete", """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    THEN 'removida' ELSE 'mantida' END AS situacao FROM orders""")
def _(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    batch = b.table(spark, sf, "customer").where("c_acctbal < 0").select(C("c_custkey").alias("o_custkey"))
    kept, removed = joins.semi_delete(orders, batch, ["o_custkey"])
    return kept.withColumn("situacao", F.lit("mantida")).unionByName(removed.withColumn("situacao", F.lit("removida"))).select(
        "o_orderkey", "o_custkey", "situacao")


# --- aggregates ------------------------------------------------------------------------------------------
_INDICATORS = f"""SELECT anomes, nm_cliente, nm_tipo_ticket, nm_status_ticket, count(*) AS total_tickets,
    CAST(count_if(foi_atuado = 1) AS BIGINT) AS tickets_atuados, CAST(count_if(foi_atuado = 0) AS BIGINT) AS tickets_nao_atuados,
    {q.mean2('sum(tempo_resolucao_horas)', 'count(tempo_resolucao_horas)')} AS tempo_medio_resolucao_horas FROM {_TICKETS} GROUP BY ALL"""
INDICATORS_SQL = q.with_ctes(_INDICATORS)


@query("ticket_indicators", INDICATORS_SQL)
def _(spark, sf):
    return marts.ticket_indicators(b.star(spark, sf).warehouse)


# The mart pairs each ticket of a day with each server row of the day. Here both are counted per day, in cents, and multiplied.
_MEAN = "CASE WHEN {n} > 0 THEN CAST(((2 * {c} + {n}) // (2 * {n})) / 100.0 AS DECIMAL(14,2)) END"
_EXECUTIVE = f"""SELECT anomes, nm_cliente, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_tickets,
    CAST(sum(coalesce(chk, 0) * m) AS BIGINT) AS qtd_checklists, CAST(sum(coalesce(csi, 0) * m) AS BIGINT) AS qtd_csi,
    CAST(sum(coalesce(cri, 0) * m) AS BIGINT) AS qtd_crises, CAST(sum(acted * m) AS BIGINT) AS tickets_atuados,
    {_MEAN.format(c="sum(hours * m)", n="sum(timed * m)")} AS tempo_medio_resolucao_horas,
    CAST(coalesce(len(list_distinct(flatten(list(seen)))), 0) AS BIGINT) AS qtd_servidores_monitorados,
    {_MEAN.format(c="sum(pct * k)", n="sum(pct_n * k)")} AS disponibilidade_media_pct, CAST(sum(minutos * k) AS BIGINT) AS total_minutos_indisponiveis,
    CAST(sum(gb * k) / 100.0 AS DECIMAL(38,2)) AS volumetria_total_gb, CAST(sum(grown * k) / 100.0 AS DECIMAL(38,2)) AS crescimento_total_mes_gb
    FROM (SELECT *, CAST(dia // 100 AS INTEGER) AS anomes, greatest(coalesce(servers, 1), 1) AS m, greatest(coalesce(n, 1), 1) AS k FROM
      (SELECT sk_tempo_criacao AS dia, nm_cliente, count(*) AS n, count_if(nm_tipo_ticket = 'Checklist') AS chk, count_if(nm_tipo_ticket = 'CSI') AS csi,
         count_if(nm_tipo_ticket = 'CRISE') AS cri, sum(foi_atuado) AS acted, CAST(sum(tempo_resolucao_horas) * 100 AS HUGEINT) AS hours,
         count(tempo_resolucao_horas) AS timed FROM {_TICKETS} GROUP BY 1, 2)
      FULL JOIN (SELECT sk_tempo_referencia AS dia, count(*) AS servers, list(sk_servidor) AS seen, CAST(sum(disponibilidade_pct) * 100 AS HUGEINT) AS pct,
         count(disponibilidade_pct) AS pct_n, sum(minutos_indisponiveis) AS minutos, CAST(sum(tamanho_gb) * 100 AS HUGEINT) AS gb,
         CAST(sum(delta_1_mes) * 100 AS HUGEINT) AS grown FROM fato_servidor GROUP BY 1) USING (dia))
    GROUP BY anomes, nm_cliente"""
EXECUTIVE_SQL = q.with_ctes(_EXECUTIVE)


@query("executive_summary", EXECUTIVE_SQL)
def _(spark, sf):
    return marts.executive_summary(b.star(spark, sf).warehouse)


@query("executive_summary_fixed", q.with_ctes(f"""SELECT coalesce(t.anomes, s.anomes) AS anomes, coalesce(t.nm, s.nm) AS nm_cliente,
    coalesce(t.n, 0) AS total_tickets, coalesce(t.chk, 0) AS qtd_checklists, coalesce(t.csi, 0) AS qtd_csi, coalesce(t.cri, 0) AS qtd_crises,
    t.acted AS tickets_atuados, t.med AS tempo_medio_resolucao_horas, coalesce(s.n, 0) AS qtd_servidores_monitorados,
    s.pct AS disponibilidade_media_pct, s.minutos AS total_minutos_indisponiveis, s.gb AS volumetria_total_gb, s.cresc AS crescimento_total_mes_gb
    FROM (SELECT sk_tempo_criacao // 100 AS anomes, c.nm_cliente AS nm, count(*) AS n, count(*) FILTER (nm_tipo_ticket = 'Checklist') AS chk,
      count(*) FILTER (nm_tipo_ticket = 'CSI') AS csi, count(*) FILTER (nm_tipo_ticket = 'CRISE') AS cri, CAST(sum(foi_atuado) AS BIGINT) AS acted,
      {q.mean2('sum(tempo_resolucao_horas)', 'count(tempo_resolucao_horas)')} AS med
      FROM fato_ticket f LEFT JOIN dim_cliente c ON c.sk_cliente = f.sk_cliente LEFT JOIN dim_tipo_ticket y ON y.sk_tipo_ticket = f.sk_tipo_ticket GROUP BY 1, 2) t
    FULL JOIN (SELECT CAST(sk_tempo_referencia // 100 AS INTEGER) AS anomes, c.nm_cliente AS nm, count(DISTINCT f.sk_servidor) AS n,
      {q.mean2('sum(disponibilidade_pct)', 'count(disponibilidade_pct)')} AS pct, CAST(sum(minutos_indisponiveis) AS BIGINT) AS minutos,
      CAST(sum(tamanho_gb) AS DECIMAL(38,2)) AS gb, CAST(sum(delta_1_mes) AS DECIMAL(38,2)) AS cresc
      FROM fato_servidor f JOIN dim_servidor s ON s.sk_servidor = f.sk_servidor LEFT JOIN dim_cliente c ON c.sk_cliente = s.sk_cliente GROUP BY 1, 2) s
    ON s.anomes = t.anomes AND s.nm IS NOT DISTINCT FROM t.nm"""))
def _(spark, sf):
    return marts.executive_summary_fixed(b.star(spark, sf).warehouse)


# What a mart holds, in figures: rows, sums of two columns and distinct names.
MART_FIGURES = {
    "vw_executiva": (_EXECUTIVE, "total_tickets", "volumetria_total_gb", "nm_cliente"),
    "vw_tecnica": (_TECHNICAL, "id_ticket_origem", "tempo_resolucao_horas", "nk_servidor"),
    "vw_executiva_disponibilidade_capacity": (_CAPACITY, "minutos_indisponiveis", "tamanho_gb", "nk_servidor"),
    "vw_csi_melhorias": (_CSI, "id_ticket_origem", "tempo_resolucao_horas", "nm_status_csi"),
    "vw_indicadores": (_INDICATORS, "total_tickets", "tempo_medio_resolucao_horas", "nm_tipo_ticket"),
    "vw_tecnica_completa": (_FULL_AS_IS, "id_ticket_origem", "tamanho_gb", "host_name"),
    "vw_tecnica_completa_mes": (_FULL_MONTH, "id_ticket_origem", "tamanho_gb", "host_name"),
}


def mart_figures(name: str, source: str) -> str:
    _, first, second, label = MART_FIGURES[name]
    return (f"SELECT '{name}' AS mart, count(*) AS linhas, CAST(sum({first}) AS DECIMAL(38,2)) AS soma_1, "
            f"CAST(sum({second}) AS DECIMAL(38,2)) AS soma_2, count(DISTINCT {label}) AS nomes FROM {source}")


MARTS_SQL = q.with_ctes(" UNION ALL ".join(mart_figures(name, f"({body[0]})") for name, body in MART_FIGURES.items()))


@query("distinct_members", q.with_ctes("""SELECT 'cliente' AS lista, CASE WHEN empresa = '' THEN 'NÃO IDENTIFICADO' ELSE empresa END AS nome FROM curated
    UNION SELECT 'tipo', tipo_ticket FROM curated UNION SELECT 'status', status_ticket FROM curated
    UNION SELECT 'status_csi', lower(csi_status) FROM curated WHERE csi_status <> ''"""))
def _(spark, sf):
    curated = b.star(spark, sf).curated
    lists = {
        "cliente": members.distinct_members(curated, "empresa", "nome", default="NÃO IDENTIFICADO"),
        "tipo": members.distinct_members(curated, "tipo_ticket", "nome"),
        "status": members.distinct_members(curated, "status_ticket", "nome"),
        "status_csi": members.distinct_members(curated, "csi_status", "nome", casefold=True),
    }
    out = None
    for label, names in lists.items():
        part = names.select(F.lit(label).alias("lista"), "nome")
        out = part if out is None else out.unionAll(part)
    return out


# --- de-duplication and windows ------------------------------------------------------------------------------
@query("keep_first", """SELECT user_id, event_id, event_type, value FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def _(spark, sf):
    events = b.table(spark, sf, "events")
    return dedupe.keep_first(events, ["user_id"], [C("ts"), C("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("canonical_server", q.with_ctes("SELECT nk_servidor, instancia, nome_servidor, ambiente, ambiente_macro, sgdb, empresa FROM ticket_servers"))
def _(spark, sf):
    return dimensions.server_members(b.star(spark, sf).curated).select(
        "nk_servidor", "instancia", "nome_servidor", "ambiente", "ambiente_macro", "sgdb", "empresa")


DELTAS_SQL = """WITH whole AS (SELECT printf('SRV-%03d', l_suppkey) AS instancia,
    CAST((year(l_shipdate) + 28) * 100 + month(l_shipdate) AS INTEGER) AS anomes, (year(l_shipdate) + 28) * 12 + month(l_shipdate) AS mi,
    CAST(sum(l_quantity) AS DECIMAL(14,2)) AS tamanho_gb FROM lineitem GROUP BY ALL)
    SELECT a.instancia, a.anomes, a.tamanho_gb, CAST(a.tamanho_gb - (SELECT tamanho_gb FROM whole b WHERE b.instancia = a.instancia AND b.mi = a.mi - 1) AS DECIMAL(15,2)) AS delta_1_mes,
    CAST(a.tamanho_gb - (SELECT tamanho_gb FROM whole b WHERE b.instancia = a.instancia AND b.mi = a.mi - 2) AS DECIMAL(15,2)) AS delta_2_meses,
    CAST(a.tamanho_gb - (SELECT tamanho_gb FROM whole b WHERE b.instancia = a.instancia AND b.mi = a.mi - 3) AS DECIMAL(15,2)) AS delta_3_meses,
    CAST(a.tamanho_gb - (SELECT tamanho_gb FROM whole b WHERE b.instancia = a.instancia AND b.mi = a.mi - 6) AS DECIMAL(15,2)) AS delta_6_meses,
    CAST(a.tamanho_gb - (SELECT tamanho_gb FROM whole b WHERE b.instancia = a.instancia AND b.mi = a.mi - 12) AS DECIMAL(15,2)) AS delta_12_meses FROM whole a"""


@query("capacity_deltas", DELTAS_SQL)
@query("capacity_deltas_all_lines", DELTAS_SQL)
def _(spark, sf):
    """Order lines of every return flag."""
    return capacity.capacity_deltas(lower_names(b.sizes(spark, sf, None)))


@query("order_staging_desc_nulls_last", q.with_ctes(
    "SELECT instancia, anomes, tamanho_gb, disponibilidade_pct FROM srv_staging ORDER BY anomes DESC NULLS LAST, instancia"))
def _(spark, sf):
    return lower_names(order_staging_desc_nulls_last(b.staging_servers(spark, sf))).select(
        "instancia", "anomes", "tamanho_gb", "disponibilidade_pct")


@query("ordered_mart", """SELECT c_mktsegment, n_name, count(c_custkey) AS clientes FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
    GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST""")
def _(spark, sf):
    customers = b.table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("c_custkey").alias("clientes"))
    nations = b.table(spark, sf, "nation").select("n_nationkey", "n_name")
    mart = nations.join(customers, C("c_nationkey") == C("n_nationkey"), "left").select(
        "c_mktsegment", "n_name", F.coalesce("clientes", F.lit(0)).alias("clientes"))
    return marts.ordered_mart(mart, "c_mktsegment", "n_name")


@query("ordered_mart_all_customers", """SELECT c_mktsegment, n_name, count(c_custkey) AS clientes
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS nation, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment
          FROM customer) FULL JOIN nation ON nation = n_nationkey
    GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST""")
def _(spark, sf):
    """All customers; by their number some are without nation or segment, which form the null groups."""
    customers = b.table(spark, sf, "customer").select(
        "c_custkey", F.when(C("c_custkey") % 7 != 0, C("c_nationkey")).alias("nation"),
        F.when(C("c_custkey") % 5 != 0, C("c_mktsegment")).alias("c_mktsegment"))
    counted = customers.groupBy("nation", "c_mktsegment").agg(F.count("c_custkey").alias("clientes"))
    nations = b.table(spark, sf, "nation").select("n_nationkey", "n_name")
    mart = nations.join(counted, C("nation") == C("n_nationkey"), "full").groupBy("c_mktsegment", "n_name").agg(
        F.coalesce(F.sum("clientes"), F.lit(0)).alias("clientes"))
    return marts.ordered_mart(mart, "c_mktsegment", "n_name")


@query("top_examples", """SELECT id FROM (SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
    ORDER BY id LIMIT 10""")
def _(spark, sf):
    only = quality.layer_difference(b.table(spark, sf, "documents"), b.table(spark, sf, "labels"), "doc_id", "doc_id")
    return quality.top_examples(only.where("somente_em = 'staging'"), ["id"], 10)


# --- set operations and writes ---------------------------------------------------------------------------------
@query("union_dates", q.with_ctes("""SELECT CAST(data_criacao AS DATE) AS data_completa FROM curated WHERE data_criacao IS NOT NULL
    UNION SELECT CAST(data_ultima_alteracao AS DATE) FROM curated WHERE data_ultima_alteracao IS NOT NULL"""))
def _(spark, sf):
    return members.union_dates(b.star(spark, sf).curated, ["data_criacao", "data_ultima_alteracao"])


@query("insert_missing_members", """SELECT s_name AS nm_cliente, false AS ativo FROM supplier
    UNION SELECT c_name, true FROM customer WHERE c_name NOT IN (SELECT s_name FROM supplier)""")
def _(spark, sf):
    wh = _warehouse(spark)
    first = b.table(spark, sf, "supplier").select(C("s_name").alias("nm_cliente"), F.lit(False).alias("ativo")).distinct()
    members.insert_missing_members(wh, first, "dim_cliente")
    second = first.select("nm_cliente").union(b.table(spark, sf, "customer").select("c_name")).distinct()
    candidates = second.withColumn("ativo", F.lit(True))
    return members.insert_missing_members(wh, candidates, "dim_cliente").select("nm_cliente", "ativo")


@query("coalesce_enrich", q.with_ctes("""SELECT t.nk_servidor, coalesce(t.instancia, f.instancia) AS instancia, f.instancia AS host_name, t.nome_servidor
    FROM ticket_servers t LEFT JOIN feed_servers f ON f.instancia = t.nk_servidor"""))
def _(spark, sf):
    dim = dimensions.server_members(b.star(spark, sf).curated).select("nk_servidor", "instancia", "host_name", "nome_servidor")
    names = b.table(spark, sf, "lineitem").select("l_suppkey").distinct().select(b.server_name().alias("nk_servidor"))
    updates = names.select("nk_servidor", *[C("nk_servidor").alias(c) for c in ("instancia", "host_name", "nome_servidor")])
    return members.coalesce_enrich(dim, updates, "nk_servidor", ["instancia", "host_name", "nome_servidor"])


@query("upsert_by_id", q.with_ctes("""SELECT id AS id_ticket_origem, company_id AS sk_cliente,
    CAST(strftime(CASE WHEN id % 50 = 0 AND id % 100 = 0 THEN created_at + INTERVAL 31 DAY ELSE created_at END, '%Y%m%d') AS INTEGER) AS sk_tempo_criacao,
    CASE WHEN id % 50 = 0 THEN 'segunda carga' ELSE subject END AS titulo_ticket FROM bt"""))
def _(spark, sf):
    wh = _warehouse(spark)
    tickets = b.raw_pages(spark, sf).select(
        C("id").alias("id_ticket_origem"), C("company_id").alias("sk_cliente"), F.lit(1).alias("sk_tipo_ticket"),
        temporal.to_day(C("created_at")).alias("dia"), C("subject").alias("titulo_ticket"), "page")
    first = tickets.where("page = 1").withColumn("sk_tempo_criacao", temporal.day_key(C("dia")))
    upserts.upsert_by_id(wh, "fato_ticket", first, sk="sk_ticket")
    # The repeated page brings new titles, and a later creation date for some tickets.
    moved = F.when(C("id_ticket_origem") % 100 == 0, F.date_add("dia", 31)).otherwise(C("dia"))
    second = tickets.where("page = 2").withColumns(
        {"sk_tempo_criacao": temporal.day_key(moved), "titulo_ticket": F.lit("segunda carga")})
    return upserts.upsert_by_id(wh, "fato_ticket", second, sk="sk_ticket").select(
        "id_ticket_origem", "sk_cliente", "sk_tempo_criacao", "titulo_ticket")


@query("replace_period", q.with_ctes("""SELECT instancia, anomes, CAST(tamanho_gb AS DECIMAL(14,2)) AS tamanho_gb,
    CAST(disponibilidade_pct AS DECIMAL(7,2)) AS disponibilidade_pct FROM srv_staging WHERE anomes // 100 <> 2025
    UNION ALL SELECT instancia, anomes, NULL, CAST(disponibilidade_pct AS DECIMAL(7,2)) FROM disp WHERE anomes // 100 = 2025"""))
def _(spark, sf):
    wh = _warehouse(spark)
    upserts.replace_period(wh, "fato_servidores_mensal", lower_names(b.staging_servers(spark, sf)))
    # A later file knows fewer servers for the months of one year.
    later = lower_names(b.availability(spark, sf)).where("anomes DIV 100 = 2025")
    return upserts.replace_period(wh, "fato_servidores_mensal", later).select(
        "instancia", "anomes", "tamanho_gb", "disponibilidade_pct")


@query("replace_month_by_date", q.with_ctes("""SELECT id_ticket, CAST(data_criacao AS DATE) AS data_criacao, tipo_ticket FROM legacy
    WHERE data_criacao NOT LIKE '2024-01-%' OR tipo_ticket = 'CSI'"""))
def _(spark, sf):
    wh = _warehouse(spark)
    legacy = build_curated_tickets_legacy(b.staging_tickets(spark, sf), **b.LEGACY_DICTIONARIES)
    typed = legacy.withColumns({c: temporal.to_day(C(c)) for c in ("data_criacao", "data_ultima_alteracao")})
    upserts.replace_month_by_date(wh, "fato_tickets", typed, 202401)
    again = typed.where("tipo_ticket = 'CSI' AND data_criacao < DATE '2024-02-01'")
    return upserts.replace_month_by_date(wh, "fato_tickets", again, 202401).select("id_ticket", "data_criacao", "tipo_ticket")


@query("layer_difference", """SELECT CAST(doc_id AS VARCHAR) AS id, 'staging' AS somente_em FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION SELECT CAST(doc_id AS VARCHAR), 'curated' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def _(spark, sf):
    return quality.layer_difference(b.table(spark, sf, "documents"), b.table(spark, sf, "labels"), "doc_id", "doc_id")


@query("assign_surrogate_keys", """SELECT CAST(500 + 1 AS BIGINT) AS menor, 500 + count(*) AS maior, count(*) AS chaves, count(DISTINCT o_orderkey) AS membros FROM orders""")
def _(spark, sf):
    new = b.table(spark, sf, "orders").select("o_orderkey")
    keyed = keys.assign_surrogate_keys(new, "o_orderkey", "sk", start=F.lit(500))
    return keyed.agg(
        F.min("sk").alias("menor"), F.max("sk").alias("maior"), F.count_distinct("sk").alias("chaves"),
        F.count("o_orderkey").alias("membros"))
