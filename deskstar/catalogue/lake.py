"""Sources, sinks, contracts and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskstar import bindings as b
from deskstar import schemas, vocab
from deskstar.catalogue import sql as q
from deskstar.catalogue.registry import query
from deskstar.functions import temporal
from deskstar.operators import capacity
from deskstar.operators.members import filter_nonblank_keys
from deskstar.plans.dimensions import load_dim_status_ticket, load_dim_tipo_ticket, seed_domain_dims
from deskstar.plans.monthly import PAGES
from deskstar.plans.refine import filter_csi, filter_valid_id, project_staging_tickets
from deskstar.session import fresh_path
from deskstar.sources import contracts, layers, raw, warehouse

C = F.col

_RAW = """id, company_id, subject, CAST(status AS VARCHAR) AS status, CAST(priority AS INTEGER) AS priority, type,
    strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at,
    cf_sgdb AS custom_fields__cf_sgdb, cf_ambiente AS custom_fields__cf_ambiente, cf_csi_status AS custom_fields__cf_csi_status"""


def undotted(df):
    """Path names with two underscores, for engines without quoted dots."""
    return df.toDF(*[c.replace(".", "__") for c in df.columns])


@query("read_raw_tickets", q.with_ctes(f"SELECT {_RAW}, window_start, page, pos FROM pages_landed"))
def _(spark, sf):
    path = b.land_ticket_pages(spark, sf, fresh_path(spark, "pages"))
    return undotted(contracts.flatten_json(raw.read_raw_tickets(spark, path, schema=PAGES)))


@query("read_raw_monitoring", q.with_ctes("""SELECT 'volumetria' AS feed, instancia, host, anomes, tamanho_gb, delta_1_mes, delta_3_meses, delta_6_meses,
    delta_12_meses, CAST(NULL AS DOUBLE) AS disponibilidade_pct, CAST(NULL AS INTEGER) AS minutos_indisponiveis FROM
    (SELECT instancia, instancia AS host, anomes, CAST(tamanho_gb AS DOUBLE) AS tamanho_gb, CAST(delta_1_mes AS DOUBLE) AS delta_1_mes,
    CAST(delta_3_meses AS DOUBLE) AS delta_3_meses, CAST(delta_6_meses AS DOUBLE) AS delta_6_meses, CAST(delta_12_meses AS DOUBLE) AS delta_12_meses FROM vol)
    UNION ALL SELECT 'disponibilidade', instancia, instancia, anomes, NULL, NULL, NULL, NULL, NULL, disponibilidade_pct, minutos_indisponiveis FROM disp"""))
def _(spark, sf):
    vol, disp = b.land_monitoring(spark, sf, fresh_path(spark, "monitoring"))
    rows = raw.read_raw_monitoring(spark, vol, "volumetry").withColumn("feed", F.lit("volumetria")).unionByName(
        raw.read_raw_monitoring(spark, disp, "availability").withColumn("feed", F.lit("disponibilidade")),
        allowMissingColumns=True,
    )
    return contracts.lower_names(rows).withColumnRenamed("host_name", "host").select(
        "feed", "instancia", "host", "anomes", "tamanho_gb", "delta_1_mes", "delta_3_meses", "delta_6_meses",
        "delta_12_meses", "disponibilidade_pct", "minutos_indisponiveis")


@query("read_delimited_auto",
       "SELECT s.sep, doc_id, lang, text, n_chars FROM documents, (VALUES (','), (';')) s(sep)")
def _(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "lang", "text", "n_chars")
    contract = schemas.columns("doc_id BIGINT, lang STRING, text STRING, n_chars BIGINT")
    parts = []
    for sep in (",", ";"):
        path = fresh_path(spark, "csv")
        docs.write.options(header=True, sep=sep, escape='"', ignoreLeadingWhiteSpace=False,
                           ignoreTrailingWhiteSpace=False).csv(path)
        parts.append(layers.read_delimited_auto(spark, path, contract).withColumn("sep", F.lit(sep)))
    return parts[0].unionByName(parts[1])


_CURATED_COLS = ", ".join(schemas.CURATED_TICKETS.names)


@query("read_layer", q.with_ctes(
    f"SELECT {_CURATED_COLS}, CAST(strftime(window_start, '%Y%m') AS INTEGER) AS anomes FROM curated WHERE strftime(window_start, '%Y%m') = '202401'"))
def _(spark, sf):
    lake = b.star(spark, sf).lake
    month = layers.read_layer(spark, lake, "curated", "tickets", 202401, schemas.CURATED_TICKETS)
    return month.select(*schemas.CURATED_TICKETS.names, "anomes")


@query("contract_check", """SELECT 'event_id' AS coluna, true AS presente, count(event_id) AS preenchidos, CAST(count(event_id) - count(try_cast(event_id AS BIGINT)) AS BIGINT) AS invalidos FROM events
    UNION ALL SELECT 'event_type', true, count(event_type), count(event_type) - count(try_cast(event_type AS INTEGER)) FROM events
    UNION ALL SELECT 'value', true, count(value), count(value) - count(try_cast(value AS DOUBLE)) FROM events
    UNION ALL SELECT 'ts', true, count(ts), 0 FROM events UNION ALL SELECT 'ausente', false, 0, 0""")
def _(spark, sf):
    contract = schemas.columns("event_id BIGINT, event_type INT, value DOUBLE, ts TIMESTAMP, ausente STRING")
    events = b.table(spark, sf, "events").select("event_id", "event_type", C("value").cast("string").alias("value"), "ts")
    return contracts.contract_check(events, contract, strict=False)


@query("align_optional_columns", q.with_ctes(
    "SELECT id, subject, CAST(NULL AS INTEGER) AS prioridade, '' AS instancia, cf_sgdb FROM bt"))
def _(spark, sf):
    contract = schemas.columns("id BIGINT, subject STRING, prioridade INT, instancia STRING, cf_sgdb STRING")
    return contracts.align_optional_columns(b.ticket_events(spark, sf), contract, {"instancia": ""})


@query("write_layer", """SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS anomes, o_orderkey, o_orderstatus FROM orders
    WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F'""")
def _(spark, sf):
    root = fresh_path(spark, "lake")
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", temporal.month_key(C("o_orderdate")).alias("anomes"))
    layers.write_layer(orders, root, "staging", "orders")
    # A second run brings new content for the months of one year; the other months stay.
    again = orders.where("o_orderstatus = 'F' AND anomes DIV 100 = 1996")
    layers.write_layer(again, root, "staging", "orders")
    return layers.read_layer(spark, root, "staging", "orders").select("anomes", "o_orderkey", "o_orderstatus")


@query("read_dimension", q.with_ctes("""SELECT 'dim_cliente' AS dimensao, nm_cliente AS chave FROM dim_cliente UNION ALL SELECT 'dim_servidor', nk_servidor FROM dim_servidor
    UNION ALL SELECT 'dim_tipo_ticket', nm_tipo_ticket FROM dim_tipo_ticket UNION ALL SELECT 'dim_status_ticket', nm_status_ticket FROM dim_status_ticket
    UNION ALL SELECT 'dim_status_csi', nm_status_csi FROM dim_status_csi UNION ALL SELECT 'dim_tempo', CAST(data_completa AS VARCHAR) FROM dim_tempo"""))
def _(spark, sf):
    wh = b.star(spark, sf).warehouse
    parts = []
    for table, (_, nk) in schemas.DIMENSION_KEYS.items():
        dim = wh.read_dimension(table, casefold=table == "dim_status_csi")
        parts.append(dim.select(F.lit(table).alias("dimensao"), C(nk).cast("string").alias("chave")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@query("append_table", """SELECT c_custkey AS sk_cliente, c_name AS nm_cliente, true AS ativo FROM customer
    UNION ALL SELECT 1000000000 + s_suppkey, s_name, false FROM supplier""")
def _(spark, sf):
    wh = warehouse.Warehouse(spark, fresh_path(spark, "dw"))
    customers = b.table(spark, sf, "customer").select(
        C("c_custkey").alias("sk_cliente"), C("c_name").alias("nm_cliente"), F.lit(True).alias("ativo"))
    suppliers = b.table(spark, sf, "supplier").select(
        (C("s_suppkey") + 1_000_000_000).alias("sk_cliente"), C("s_name").alias("nm_cliente"), F.lit(False).alias("ativo"))
    warehouse.append_table(customers, wh, "dim_cliente")
    return warehouse.append_table(suppliers, wh, "dim_cliente")


@query("load_lineage_columns", """SELECT o_orderkey, '20260415_124748' AS stamp, 'sem_stamp' AS sem_arquivo, TIMESTAMP '2024-02-01 00:00:00' AS data_carga FROM orders""")
def _(spark, sf):
    path = f"{fresh_path(spark, 'lineage')}/servidores_20260415_124748"
    b.table(spark, sf, "orders").select("o_orderkey").write.parquet(path)
    marked = layers.load_lineage_columns(spark.read.parquet(path), load_ts=b.load_ts())
    return marked.select(
        "o_orderkey", "stamp", layers.load_stamp(F.lit("carga.csv")).alias("sem_arquivo"),
        C("data_carga").cast("timestamp_ntz").alias("data_carga"))


@query("month_week_windows", """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS a FROM orders),
    w AS (SELECT a + CAST(7 * i AS INTEGER) AS ini, least(a + CAST(7 * (i + 1) AS INTEGER), CAST(a + INTERVAL 1 MONTH AS DATE)) AS fim
          FROM m, range(5) t(i) WHERE a + CAST(7 * i AS INTEGER) < CAST(a + INTERVAL 1 MONTH AS DATE))
    SELECT ini AS window_start, fim AS window_end_excl, count(o_orderkey) AS pedidos FROM w
    LEFT JOIN orders ON o_orderdate >= ini AND o_orderdate < fim GROUP BY ALL""")
def _(spark, sf):
    orders = b.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
    months = orders.select(F.trunc("dia", "MM").alias("first")).distinct()
    windows = capacity.windows_of_months(months, "first")
    counted = capacity.bucket_into_weeks(orders, C("dia")).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("pedidos"))
    return windows.join(counted, "window_start", "left").select(
        "window_start", "window_end_excl", F.coalesce("pedidos", F.lit(0)).alias("pedidos"))


@query("dedupe_landed_pages", q.with_ctes(
    "SELECT id, page, pos, CAST(status AS VARCHAR) AS status, window_start FROM bt"))
def _(spark, sf):
    return raw.dedupe_landed_pages(b.raw_pages(spark, sf)).select("id", "page", "pos", "status", "window_start")


@query("create_star", q.with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS tabela, count(*) AS linhas FROM {t}" for t in schemas.STAR_TABLES)))
def _(spark, sf):
    """Declared empty, then loaded: the declared tables show the rows."""
    root = fresh_path(spark, "dw")
    warehouse.drop_star(spark, "dw")
    warehouse.create_star(spark, root, "dw")
    b.load_star(warehouse.Warehouse(spark, root), b.star(spark, sf).curated, b.staging_servers(spark, sf))
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{t}' AS tabela, count(*) AS linhas FROM dw.{t}" for t in schemas.STAR_TABLES))


def _seed_union(table: str, nk: str) -> str:
    values = ", ".join(f"('{v}')" for v in vocab.SEED_MEMBERS[table])
    return f"SELECT '{table}' AS tabela, n AS nome FROM (VALUES {values}) v(n) UNION SELECT '{table}', {nk} FROM {table}"


@query("seed_domain_dims", q.with_ctes(
    f"{_seed_union('dim_tipo_ticket', 'nm_tipo_ticket')} UNION {_seed_union('dim_status_ticket', 'nm_status_ticket')}"))
def _(spark, sf):
    wh = warehouse.Warehouse(spark, fresh_path(spark, "dw"))
    seed_domain_dims(wh)
    curated = b.star(spark, sf).curated
    types, status = load_dim_tipo_ticket(wh, curated), load_dim_status_ticket(wh, curated)
    return types.select(F.lit("dim_tipo_ticket").alias("tabela"), C("nm_tipo_ticket").alias("nome")).unionAll(
        status.select(F.lit("dim_status_ticket"), "nm_status_ticket"))


@query("flatten_json", q.with_ctes(f"SELECT {_RAW}, window_start, page, pos FROM pages_landed"))
def _(spark, sf):
    return contracts.flatten_json(b.raw_pages(spark, sf), sep="__")


@query("project_staging_tickets", q.with_ctes(f"SELECT {_RAW} FROM pages_landed"))
def _(spark, sf):
    return undotted(project_staging_tickets(contracts.flatten_json(b.raw_pages(spark, sf))))


@query("rename_columns", """SELECT l_suppkey AS servidor, l_shipdate AS data_referencia, l_quantity AS tamanho_gb, l_returnflag FROM lineitem""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    return contracts.rename_columns(
        rows, {"l_suppkey": "servidor", "l_shipdate": "data_referencia", "l_quantity": "tamanho_gb"})


@query("filter_valid_id", q.with_ctes("SELECT id AS id_ticket, subject FROM bt WHERE status IS DISTINCT FROM 3"))
def _(spark, sf):
    spelled = F.when(C("status").eqNullSafe(3), F.concat(F.lit("#"), C("id"))).otherwise(C("id").cast("string"))
    named = b.ticket_events(spark, sf).withColumn("id", spelled)
    return filter_valid_id(named, "id", "id_ticket").select("id_ticket", "subject")


@query("filter_csi", q.with_ctes("SELECT id, type FROM bt WHERE type = 'csi'"))
def _(spark, sf):
    return filter_csi(b.ticket_events(spark, sf).select("id", "type"), "type")


@query("filter_nonblank_keys", q.with_ctes("SELECT id_ticket, nk_servidor FROM curated WHERE nk_servidor <> ''"))
def _(spark, sf):
    return filter_nonblank_keys(b.curated_tickets(spark, sf), ["nk_servidor", "nome_servidor"]).select(
        "id_ticket", "nk_servidor")
