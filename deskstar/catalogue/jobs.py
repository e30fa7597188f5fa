"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskstar import bindings as b
from deskstar import schemas
from deskstar.catalogue import sql as q
from deskstar.catalogue.lake import _RAW, undotted
from deskstar.catalogue.registry import query
from deskstar.catalogue.relational import EXECUTIVE_SQL, MARTS_SQL, mart_figures
from deskstar.plans import dimensions, facts, marts
from deskstar.plans.monthly import MonthlyInputs, run_month, run_month_legacy
from deskstar.plans.refine import build_curated_tickets_legacy
from deskstar.session import fresh_path
from deskstar.sources.contracts import lower_names
from deskstar.sources.warehouse import Warehouse
from deskstar.streaming.tickets import stream_tickets

C = F.col
_CURATED = ", ".join(schemas.CURATED_TICKETS.names)
_LEGACY = ", ".join(schemas.CURATED_TICKETS_LEGACY.names)
_SERVERS = ", ".join(c.lower() for c in schemas.STAGING_SERVERS.names)


def _warehouse(spark) -> Warehouse:
    return Warehouse(spark, fresh_path(spark, "dw"))


@query("build_staging_tickets", q.with_ctes(f"SELECT {_RAW} FROM bt"))
def _(spark, sf):
    return undotted(b.staging_tickets(spark, sf).drop("ordem", "anomes"))


@query("build_staging_servers", q.with_ctes(f"SELECT {_SERVERS} FROM srv_staging"))
def _(spark, sf):
    return lower_names(b.staging_servers(spark, sf, ordered=True))


@query("build_curated_tickets", q.with_ctes(f"SELECT {_CURATED} FROM curated"))
def _(spark, sf):
    return b.curated_tickets(spark, sf).select(*schemas.CURATED_TICKETS.names)


@query("build_curated_tickets_legacy", q.with_ctes(f"SELECT {_LEGACY} FROM legacy"))
def _(spark, sf):
    return build_curated_tickets_legacy(b.staging_tickets(spark, sf), **b.LEGACY_DICTIONARIES).select(
        *schemas.CURATED_TICKETS_LEGACY.names)


@query("load_dimensions", q.with_ctes(f"""SELECT 'dim_cliente' AS dimensao, nm_cliente AS chave FROM dim_cliente
    UNION ALL SELECT 'dim_tipo_ticket', nm_tipo_ticket FROM dim_tipo_ticket UNION ALL SELECT 'dim_status_ticket', nm_status_ticket FROM dim_status_ticket
    UNION ALL SELECT 'dim_status_csi', nm_status_csi FROM dim_status_csi UNION ALL SELECT 'dim_servidor', nk_servidor FROM ticket_servers
    UNION ALL SELECT 'dim_tempo', d FROM (SELECT data_criacao AS d FROM curated UNION SELECT data_ultima_alteracao FROM curated) WHERE d IS NOT NULL"""))
def _(spark, sf):
    wh = _warehouse(spark)
    curated = b.star(spark, sf).curated
    dimensions.load_dimensions(wh, curated)
    dims = dimensions.load_dimensions(wh, curated)  # loading twice changes nothing
    out = None
    for table, df in dims.items():
        part = df.select(F.lit(table).alias("dimensao"), C(schemas.DIMENSION_KEYS[table][1]).cast("string").alias("chave"))
        out = part if out is None else out.unionAll(part)
    return out


_TICKET_SQL = q.with_ctes("""SELECT f.id_ticket_origem, c.nm_cliente, s.nk_servidor, t.nm_tipo_ticket, f.sk_tempo_criacao, f.sk_tempo_ultima_alt,
    f.foi_atuado, f.tempo_resolucao_horas, f.titulo_ticket FROM fato_ticket f LEFT JOIN dim_cliente c ON c.sk_cliente = f.sk_cliente
    LEFT JOIN dim_servidor s ON s.sk_servidor = f.sk_servidor LEFT JOIN dim_tipo_ticket t ON t.sk_tipo_ticket = f.sk_tipo_ticket""")


def _named(wh: Warehouse, fact, names: dict[str, str]):
    """Replace surrogate keys by the names they stand for."""
    for sk, table in names.items():
        dim = wh.read_dimension(table)
        fact = fact.join(dim.withColumnRenamed(dim.columns[0], "_sk"), C(sk) == C("_sk"), "left").drop("_sk", sk)
    return fact


@query("load_fato_ticket", _TICKET_SQL)
def _(spark, sf):
    wh = _warehouse(spark)
    curated = b.star(spark, sf).curated
    dimensions.load_dimensions(wh, curated)
    facts.load_fato_ticket(wh, curated, "strict", b.load_ts())
    fact = facts.load_fato_ticket(wh, curated, "strict", b.load_ts())
    named = _named(wh, fact, {"sk_cliente": "dim_cliente", "sk_servidor": "dim_servidor", "sk_tipo_ticket": "dim_tipo_ticket"})
    return named.select("id_ticket_origem", "nm_cliente", "nk_servidor", "nm_tipo_ticket", "sk_tempo_criacao",
                        "sk_tempo_ultima_alt", "foi_atuado", "tempo_resolucao_horas", "titulo_ticket")


@query("load_fato_csi", q.with_ctes("""SELECT f.id_ticket_origem, c.nm_cliente, s.nk_servidor, t.nm_status_csi, f.sk_tempo_criacao, f.sk_tempo_fechamento,
    f.foi_atuado, f.tempo_resolucao_horas, f.titulo_csi FROM fato_csi f LEFT JOIN dim_cliente c ON c.sk_cliente = f.sk_cliente
    LEFT JOIN dim_servidor s ON s.sk_servidor = f.sk_servidor LEFT JOIN dim_status_csi t ON t.sk_status_csi = f.sk_status_csi"""))
def _(spark, sf):
    wh = _warehouse(spark)
    curated = b.star(spark, sf).curated
    dimensions.load_dimensions(wh, curated)
    fact = facts.load_fato_csi(wh, curated, "quarantine", b.load_ts())
    named = _named(wh, fact, {"sk_cliente": "dim_cliente", "sk_servidor": "dim_servidor", "sk_status_csi": "dim_status_csi"})
    return named.select("id_ticket_origem", "nm_cliente", "nk_servidor", "nm_status_csi", "sk_tempo_criacao",
                        "sk_tempo_fechamento", "foi_atuado", "tempo_resolucao_horas", "titulo_csi")


@query("load_fato_servidor", q.with_ctes("""SELECT instancia AS nk_servidor, anomes * 100 + 1 AS sk_tempo_referencia, CAST(tamanho_gb AS DECIMAL(14,2)) AS tamanho_gb,
    CAST(delta_1_mes AS DECIMAL(14,2)) AS delta_1_mes, CAST(delta_12_meses AS DECIMAL(14,2)) AS delta_12_meses,
    CAST(disponibilidade_pct AS DECIMAL(7,2)) AS disponibilidade_pct, minutos_indisponiveis FROM srv_staging"""))
def _(spark, sf):
    wh = _warehouse(spark)
    fact = facts.load_fato_servidor(wh, b.staging_servers(spark, sf), b.SOURCE, "strict", b.load_ts())
    return _named(wh, fact, {"sk_servidor": "dim_servidor"}).select(
        "nk_servidor", "sk_tempo_referencia", "tamanho_gb", "delta_1_mes", "delta_12_meses", "disponibilidade_pct",
        "minutos_indisponiveis")


@query("load_flat_servers", q.with_ctes("""SELECT instancia, host_name, anomes, make_date(CAST(anomes // 100 AS INTEGER), CAST(anomes % 100 AS INTEGER), 1) AS data_referencia,
    CAST(tamanho_gb AS DECIMAL(14,2)) AS tamanho_gb, CAST(delta_3_meses AS DECIMAL(14,2)) AS delta_3_meses, minutos_indisponiveis FROM srv_staging"""))
def _(spark, sf):
    return facts.load_flat_servers(_warehouse(spark), b.staging_servers(spark, sf)).select(
        "instancia", "host_name", "anomes", "data_referencia", "tamanho_gb", "delta_3_meses", "minutos_indisponiveis")


_FLAT_SQL = q.with_ctes("""SELECT id_ticket, empresa, CAST(data_criacao AS DATE) AS data_criacao, CAST(nullif(data_ultima_alteracao, '') AS DATE) AS data_ultima_alteracao,
    tipo_ticket, status_ticket, foi_atuado, titulo_ticket, csi_status FROM legacy""")


@query("load_flat_tickets", _FLAT_SQL)
def _(spark, sf):
    legacy = build_curated_tickets_legacy(b.staging_tickets(spark, sf), **b.LEGACY_DICTIONARIES)
    return facts.load_flat_tickets(_warehouse(spark), legacy, 202401)


@query("run_month", EXECUTIVE_SQL)
def _(spark, sf):
    root = fresh_path(spark, "month")
    vol, disp = b.land_monitoring(spark, sf, f"{root}/raw/servidores")
    inputs = MonthlyInputs(b.land_ticket_pages(spark, sf, f"{root}/raw/tickets"), vol, disp)
    wh = Warehouse(spark, f"{root}/dw")
    run_month(spark, f"{root}/lake", wh, 2024, 1, inputs, "quarantine", b.load_ts(), **b.DICTIONARIES)
    return marts.executive_summary(wh)


def _staged_file(spark, sf, path: str) -> str:
    """All staged servers as delimited files."""
    b.staging_servers(spark, sf).write.options(header=True).csv(path)
    return path


@query("run_month_staged", EXECUTIVE_SQL)
def _(spark, sf):
    """The same month, its servers read from a staged file."""
    root = fresh_path(spark, "month")
    inputs = MonthlyInputs(b.land_ticket_pages(spark, sf, f"{root}/raw/tickets"), servers=_staged_file(spark, sf, f"{root}/staged"))
    wh = Warehouse(spark, f"{root}/dw")
    run_month(spark, f"{root}/lake", wh, 2024, 1, inputs, "quarantine", b.load_ts(), **b.DICTIONARIES)
    return marts.executive_summary(wh)


@query("run_month_legacy", _FLAT_SQL)
def _(spark, sf):
    root = fresh_path(spark, "month")
    wh = Warehouse(spark, f"{root}/dw")
    inputs = MonthlyInputs(b.land_ticket_pages(spark, sf, f"{root}/raw/tickets"))
    run_month_legacy(spark, f"{root}/lake", wh, 2024, 1, inputs, "quarantine", **b.LEGACY_DICTIONARIES)
    return wh.read("fato_tickets")


@query("publish_marts", MARTS_SQL)
def _(spark, sf):
    names = marts.publish_marts(b.star(spark, sf).warehouse)
    return spark.sql(" UNION ALL ".join(mart_figures(name, name) for name in names))


@query("stream_tickets", _TICKET_SQL)
def _(spark, sf):
    root = fresh_path(spark, "stream")
    wh = Warehouse(spark, f"{root}/dw")
    landing = b.land_ticket_pages(spark, sf, f"{root}/raw")
    stream_tickets(wh, landing, f"{root}/checkpoint", load_ts=b.load_ts(), **b.DICTIONARIES).awaitTermination()
    named = _named(wh, wh.read("fato_ticket"),
                   {"sk_cliente": "dim_cliente", "sk_servidor": "dim_servidor", "sk_tipo_ticket": "dim_tipo_ticket"})
    return named.select("id_ticket_origem", "nm_cliente", "nk_servidor", "nm_tipo_ticket", "sk_tempo_criacao",
                        "sk_tempo_ultima_alt", "foi_atuado", "tempo_resolucao_horas", "titulo_ticket")


@query("stream_tickets_status", q.with_ctes("""SELECT f.id_ticket_origem, t.nm_status_ticket FROM fato_ticket f
    LEFT JOIN dim_status_ticket t ON t.sk_status_ticket = f.sk_status_ticket"""))
def _(spark, sf):
    """The status, which differs between the copies of a ticket, from many small micro-batches."""
    root = fresh_path(spark, "stream")
    wh = Warehouse(spark, f"{root}/dw")
    landing = b.land_ticket_pages(spark, sf, f"{root}/raw")
    stream_tickets(wh, landing, f"{root}/checkpoint", files_per_batch=4, load_ts=b.load_ts(), **b.DICTIONARIES).awaitTermination()
    return _named(wh, wh.read("fato_ticket"), {"sk_status_ticket": "dim_status_ticket"}).select("id_ticket_origem", "nm_status_ticket")
