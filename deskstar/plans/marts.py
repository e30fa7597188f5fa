"""The six analytical marts over the star.

Facts are aggregated before they meet dimensions wherever the result allows it; detail marts look
dimensions up next to the fact. The two marts whose original join multiplies rows are given as they
are and as ``*_fixed``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskstar.functions.numeric import case_buckets, exact_mean
from deskstar.operators.joins import left_lookup, small
from deskstar.sources.warehouse import Warehouse

SERVER_SUMS = ("minutos_indisponiveis", "tamanho_gb", "delta_1_mes")


def ordered_mart(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending order with NULL last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small(df) else df


def _total(c: Column | str) -> Column:
    return F.sum(F.col(c) if isinstance(c, str) else c)


def _wide(c: Column) -> Column:
    return c.cast("decimal(28,2)")


# --- detail marts ------------------------------------------------------------------------------------
def _dated(warehouse: Warehouse, table: str, cols: list[str]) -> DataFrame:
    """A ticket fact with its day; the month joins the fact's partitions, so a filter on it prunes them."""
    days = warehouse.read("dim_tempo").select(F.col("sk_tempo").alias("_key"), F.col("anomes").alias("_month"), *cols)
    on = [("sk_tempo_criacao", "_key"), ("mes_criacao", "_month")]
    return left_lookup(warehouse.physical(table), days, on, ["id_ticket_origem"])


def _server_months(warehouse: Warehouse) -> DataFrame:
    """The server fact with its month, an expression of the partition column, so a filter on it prunes partitions."""
    month = F.expr("CAST(sk_tempo_referencia DIV 100 AS INT)")
    return warehouse.read("fato_servidor").withColumn("anomes", month)


def _lookup(warehouse: Warehouse, fact: DataFrame, table: str, on: tuple[str, str], cols: list[str]) -> DataFrame:
    dim = warehouse.read(table).select(F.col(on[1]).alias("_key"), *cols)
    return left_lookup(fact, dim, [(on[0], "_key")], ["id_ticket_origem"])


def star_detail_left(warehouse: Warehouse) -> DataFrame:
    """Technical mart: one row per ticket with its five dimensions."""
    df = _dated(warehouse, "fato_ticket", ["anomes", "data_completa"])
    df = _lookup(warehouse, df, "dim_cliente", ("sk_cliente", "sk_cliente"), ["nm_cliente"])
    df = _lookup(warehouse, df, "dim_tipo_ticket", ("sk_tipo_ticket", "sk_tipo_ticket"), ["nm_tipo_ticket"])
    df = _lookup(warehouse, df, "dim_status_ticket", ("sk_status_ticket", "sk_status_ticket"), ["nm_status_ticket"])
    server = ["nk_servidor", "nome_servidor", "instancia", "host_name", "sgdb", "ambiente", "ambiente_macro"]
    df = _lookup(warehouse, df, "dim_servidor", ("sk_servidor", "sk_servidor"), server)
    return df.select(
        "anomes", "data_completa", "id_ticket_origem", "nm_cliente", "nm_tipo_ticket",
        "nm_status_ticket", *server, "foi_atuado", "tempo_resolucao_horas", "titulo_ticket", "data_carga",
    )


def star_detail_csi(warehouse: Warehouse) -> DataFrame:
    """Improvement mart: one row per improvement ticket."""
    df = _dated(warehouse, "fato_csi", ["anomes"])
    df = _lookup(warehouse, df, "dim_cliente", ("sk_cliente", "sk_cliente"), ["nm_cliente"])
    server = ["nk_servidor", "instancia", "nome_servidor"]
    df = _lookup(warehouse, df, "dim_servidor", ("sk_servidor", "sk_servidor"), server)
    df = _lookup(warehouse, df, "dim_status_csi", ("sk_status_csi", "sk_status_csi"), ["nm_status_csi"])
    return df.select(
        "anomes", "id_ticket_origem", "nm_cliente", *server, "nm_status_csi", "titulo_csi",
        "foi_atuado", "tempo_resolucao_horas", "data_carga",
    )


def star_detail_inner(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    """Capacity mart: one row per server and month, labelled."""
    months = warehouse.read("dim_tempo").select(F.col("sk_tempo").alias("sk_tempo_referencia"), "anomes")
    attributes = ["nk_servidor", "instancia", "host_name", "nome_servidor", "sgdb", "ambiente", "ambiente_macro"]
    servers = warehouse.read("dim_servidor").select("sk_servidor", *attributes)
    metrics = ["tamanho_gb", "delta_1_mes", "delta_3_meses", "delta_6_meses", "delta_12_meses",
               "disponibilidade_pct", "minutos_indisponiveis"]
    joined = (
        _server_months(warehouse)
        .join(_sized(months), ["sk_tempo_referencia", "anomes"])
        .join(_sized(servers), "sk_servidor")
        .select("anomes", *attributes, *metrics)
    )
    mart = case_buckets(joined)
    return ordered_mart(mart, "anomes", "nk_servidor") if ordered else mart


METRICS = ["tamanho_gb", "delta_1_mes", "delta_3_meses", "delta_6_meses", "delta_12_meses",
           "disponibilidade_pct", "minutos_indisponiveis"]
TICKET_SERVER = ["nk_servidor", "instancia", "host_name", "sgdb", "ambiente"]


def _ticket_with_host(warehouse: Warehouse) -> DataFrame:
    """Tickets with dimensions and, through the bridge, the key of the physical server."""
    df = _dated(warehouse, "fato_ticket", ["anomes", "data_completa"])
    df = _lookup(warehouse, df, "dim_cliente", ("sk_cliente", "sk_cliente"), ["nm_cliente"])
    df = _lookup(warehouse, df, "dim_tipo_ticket", ("sk_tipo_ticket", "sk_tipo_ticket"), ["nm_tipo_ticket"])
    df = _lookup(warehouse, df, "dim_status_ticket", ("sk_status_ticket", "sk_status_ticket"), ["nm_status_ticket"])
    df = _lookup(warehouse, df, "dim_servidor", ("sk_servidor", "sk_servidor"), TICKET_SERVER)
    bridge = warehouse.read("map_servidor_instancia").select(
        F.col("instancia").alias("_i"), F.col("host_name").alias("_host")
    )
    df = left_lookup(df, bridge, [("instancia", "_i")], ["id_ticket_origem"])
    hosts = warehouse.read("dim_servidor").select(
        F.col("host_name").alias("_h"), F.col("sk_servidor").alias("_sk_host")
    )
    return left_lookup(df, hosts, [("_host", "_h")], ["id_ticket_origem"])


def _full_technical(df: DataFrame) -> DataFrame:
    return df.select(
        "anomes", "data_completa", "id_ticket_origem", "nm_cliente", "nm_tipo_ticket",
        "nm_status_ticket", *TICKET_SERVER, "foi_atuado", "tempo_resolucao_horas", "titulo_ticket", *METRICS,
    )


BRIDGED_ROWS = 200_000  # server months that are broadcast at most; a row takes about 150 bytes in memory


def _of_bridged_hosts(warehouse: Warehouse, metrics: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The server months (key ``_sk``) of hosts that the bridge names, and how to look them up.

    No ticket finds other ones. The planned size knows nothing of that, so the rows are counted: a short list is
    broadcast, and no ticket is shuffled for it.
    """
    bridge, servers = warehouse.read("map_servidor_instancia"), warehouse.read("dim_servidor")
    hosts = servers.join(_sized(bridge.select("host_name")), "host_name", "left_semi").select(F.col("sk_servidor").alias("_sk"))
    kept = metrics.join(_sized(hosts), "_sk", "left_semi")
    short = kept.select("_sk").limit(BRIDGED_ROWS + 1).count() <= BRIDGED_ROWS
    return kept, {"limit": sys.maxsize} if short else {}


def bridge_join(warehouse: Warehouse) -> DataFrame:
    """Full technical mart as defined: a ticket repeats for every month of its physical server.

    The definition ends with an outer join to the time dimension on its key. That join neither
    filters, repeats nor contributes a column, so it is left out.
    """
    metrics = warehouse.read("fato_servidor").select(F.col("sk_servidor").alias("_sk"), *METRICS)
    metrics, how = _of_bridged_hosts(warehouse, metrics)
    df = left_lookup(_ticket_with_host(warehouse), metrics, [("_sk_host", "_sk")], ["id_ticket_origem"], **how)
    return _full_technical(df)


def bridge_join_fixed(warehouse: Warehouse) -> DataFrame:
    """Full technical mart with the metrics of the ticket's own month only."""
    months = warehouse.read("dim_tempo").select(F.col("sk_tempo").alias("sk_tempo_referencia"), "anomes")
    metrics = (
        _server_months(warehouse)
        .join(_sized(months), ["sk_tempo_referencia", "anomes"])
        .select(F.col("sk_servidor").alias("_sk"), F.col("anomes").alias("_m"), *METRICS)
    )
    on = [("_sk_host", "_sk"), ("anomes", "_m")]
    metrics, how = _of_bridged_hosts(warehouse, metrics)
    return _full_technical(left_lookup(_ticket_with_host(warehouse), metrics, on, ["id_ticket_origem"], **how))


# --- aggregate marts ---------------------------------------------------------------------------------
def ticket_indicators(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    """Tickets per month, customer, type and status.

    The fact is folded to its own keys first, so only group rows meet the dimensions.
    """
    keys = ["sk_tempo_criacao", "mes_criacao", "sk_cliente", "sk_tipo_ticket", "sk_status_ticket"]
    folded = (
        warehouse.physical("fato_ticket").groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"),
            _total("foi_atuado").alias("acted"),
            _total("tempo_resolucao_horas").alias("hours"),
            F.count("tempo_resolucao_horas").alias("timed"),
        )
    )
    months = warehouse.read("dim_tempo").select(
        F.col("sk_tempo").alias("sk_tempo_criacao"), F.col("anomes").alias("mes_criacao"), "anomes")
    named = (
        folded.join(_sized(months), ["sk_tempo_criacao", "mes_criacao"])
        .join(_sized(warehouse.read("dim_cliente").select("sk_cliente", "nm_cliente")), "sk_cliente")
        .join(_sized(warehouse.read("dim_tipo_ticket")), "sk_tipo_ticket")
        .join(_sized(warehouse.read("dim_status_ticket")), "sk_status_ticket", "left")
    )
    group = ["anomes", "nm_cliente", "nm_tipo_ticket", "nm_status_ticket"]
    mart = named.groupBy(*group).agg(
        _total("n").alias("total_tickets"),
        _total("acted").alias("tickets_atuados"),
        (_total("n") - _total("acted")).alias("tickets_nao_atuados"),
        exact_mean(_total("hours"), _total("timed")).alias("tempo_medio_resolucao_horas"),
    )
    return ordered_mart(mart, *group) if ordered else mart


def _ticket_days(warehouse: Warehouse) -> DataFrame:
    """Tickets folded to (day, customer), with the month. A ticket id is unique, so rows are distinct tickets."""
    folded = (
        warehouse.physical("fato_ticket")
        .groupBy("sk_tempo_criacao", "mes_criacao", "sk_cliente", "sk_tipo_ticket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            _total("foi_atuado").alias("acted"),
            _total("tempo_resolucao_horas").alias("hours"),
            F.count("tempo_resolucao_horas").alias("timed"),
        )
    )
    named = folded.join(
        _sized(warehouse.read("dim_cliente").select("sk_cliente", "nm_cliente")), "sk_cliente", "left"
    ).join(_sized(warehouse.read("dim_tipo_ticket")), "sk_tipo_ticket", "left")

    def of_type(label: str, name: str) -> Column:
        return F.sum(F.when(F.col("nm_tipo_ticket") == label, F.col("n")).otherwise(0)).alias(name)

    day = [F.col("sk_tempo_criacao").alias("sk_tempo"), F.col("mes_criacao").alias("anomes")]
    return named.groupBy(*day, "nm_cliente").agg(
        _total("n").alias("n"),
        of_type("Checklist", "checklists"),
        of_type("CSI", "csi"),
        of_type("CRISE", "crises"),
        _total("acted").alias("acted"),
        _total("hours").alias("hours"),
        _total("timed").alias("timed"),
    )


def _server_days(warehouse: Warehouse) -> DataFrame:
    return _server_months(warehouse).groupBy(F.col("sk_tempo_referencia").alias("sk_tempo"), "anomes").agg(
        F.count(F.lit(1)).alias("servers"),
        _total("disponibilidade_pct").alias("pct"),
        F.count("disponibilidade_pct").alias("pct_n"),
        *[_total(c).alias(c) for c in SERVER_SUMS],
    )


def calendar_two_fact_join(warehouse: Warehouse) -> DataFrame:
    """Both facts per calendar day and customer, each already folded.

    The original join pairs every ticket of a day with every server row of that day. ``tickets`` and
    ``servers`` are the multiplicities of the two sides, so any sum over that product is a sum here
    times the multiplicity of the other side, and the product is never built.
    """
    calendar = warehouse.read("dim_tempo").select("sk_tempo", "anomes", "dia")
    # A day has one server row. It goes to each ticket row of the day, and stays alone where there is none; as a union
    # with a window, not as a full join, through which no filter on the month would reach the facts.
    day = Window.partitionBy("anomes", "sk_tempo")
    measures = ["servers", "pct", "pct_n", *SERVER_SUMS]
    both = _ticket_days(warehouse).unionByName(_server_days(warehouse), allowMissingColumns=True)
    both = both.withColumns({
        **{c: F.max(c).over(day) for c in measures}, "_tickets": F.max("n").over(day)})
    paired = both.where(F.col("n").isNotNull() | F.col("_tickets").isNull())
    return paired.join(_sized(calendar), ["sk_tempo", "anomes"]).select(
        "anomes", "dia", "nm_cliente", F.col("n").alias("tickets"), "checklists", "csi", "crises",
        "acted", "hours", "timed", *measures,
    )


def _server_day_masks(warehouse: Warehouse) -> DataFrame:
    """(month, set of days, servers seen on exactly these days); a set of days is a bit mask."""
    calendar = warehouse.read("dim_tempo").select(
        F.col("sk_tempo").alias("sk_tempo_referencia"), "anomes", "dia"
    )
    days = _server_months(warehouse).join(_sized(calendar), ["sk_tempo_referencia", "anomes"])
    per_server = days.groupBy("anomes", "sk_servidor").agg(F.bit_or(_day_bit()).alias("server_days"))
    return per_server.groupBy("anomes", "server_days").agg(F.count(F.lit(1)).alias("seen"))


def _day_bit() -> Column:
    return F.expr("shiftleft(1L, CAST(dia AS INT))")


def executive_summary(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    """Executive mart as defined, multiplied sums included, without building the product."""
    per_day = calendar_two_fact_join(warehouse)
    by_servers = F.greatest(F.coalesce("servers", F.lit(1)), F.lit(1))
    by_tickets = F.greatest(F.coalesce("tickets", F.lit(1)), F.lit(1))
    group = ["anomes", "nm_cliente"]

    def counted(name: str) -> Column:
        return F.sum(F.coalesce(name, F.lit(0)) * by_servers)

    def spread(name: str) -> Column:
        return F.sum(_wide(F.col(name)) * by_tickets.cast("decimal(10,0)"))

    folded = per_day.groupBy(*group).agg(
        F.sum(F.coalesce("tickets", F.lit(0))).alias("total_tickets"),
        counted("checklists").alias("qtd_checklists"),
        counted("csi").alias("qtd_csi"),
        counted("crises").alias("qtd_crises"),
        F.sum(F.col("acted") * by_servers).alias("tickets_atuados"),
        exact_mean(
            F.sum(_wide(F.col("hours")) * by_servers.cast("decimal(10,0)")),
            F.sum(F.col("timed") * by_servers),
        ).alias("tempo_medio_resolucao_horas"),
        exact_mean(spread("pct"), F.sum(F.col("pct_n") * by_tickets)).alias("disponibilidade_media_pct"),
        F.sum(F.col("minutos_indisponiveis") * by_tickets).alias("total_minutos_indisponiveis"),
        spread("tamanho_gb").cast("decimal(38,2)").alias("volumetria_total_gb"),
        spread("delta_1_mes").cast("decimal(38,2)").alias("crescimento_total_mes_gb"),
        F.bit_or(_day_bit()).alias("group_days"),
    )
    counted_servers = _servers_per_group(folded, _server_day_masks(warehouse))
    mart = _executive_columns(counted_servers)
    return ordered_mart(mart, *group) if ordered else mart


def _servers_per_group(groups: DataFrame, masks: DataFrame) -> DataFrame:
    """Distinct servers of a group: those seen on any day of the group.

    The loader keys a month of servers to one day, so a month has one day set and a group meets one
    row. Grouping by the whole group row keeps a single pass over the tickets.
    """
    sets = masks.withColumnRenamed("anomes", "_a")
    shared = F.col("group_days").bitwiseAND(F.col("server_days")) != 0
    met = groups.join(sets, (F.col("anomes") == F.col("_a")) & shared, "left")
    seen = F.coalesce(F.sum("seen"), F.lit(0).cast("bigint"))
    return met.groupBy(*groups.columns).agg(seen.alias("qtd_servidores_monitorados"))


def _executive_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "anomes", "nm_cliente", "total_tickets", "qtd_checklists", "qtd_csi", "qtd_crises",
        "tickets_atuados", "tempo_medio_resolucao_horas", "qtd_servidores_monitorados",
        "disponibilidade_media_pct", "total_minutos_indisponiveis", "volumetria_total_gb",
        "crescimento_total_mes_gb",
    )


def executive_summary_fixed(warehouse: Warehouse, ordered: bool = True) -> DataFrame:
    """Executive mart with each fact folded to (month, customer) before they meet.

    Server metrics go to the customer that owns the server, so totals equal those of the facts.
    """
    calendar = warehouse.read("dim_tempo").select("sk_tempo", "anomes")
    group = ["anomes", "nm_cliente"]
    tickets = _ticket_days(warehouse).join(_sized(calendar), ["sk_tempo", "anomes"]).groupBy(*group).agg(
        *[_total(c).alias(c) for c in ("n", "checklists", "csi", "crises", "acted", "hours", "timed")]
    )
    per_server = (
        _server_months(warehouse).withColumnRenamed("sk_tempo_referencia", "sk_tempo")
        .join(_sized(calendar), ["sk_tempo", "anomes"])
        .groupBy("anomes", "sk_servidor")
        .agg(
            _total("disponibilidade_pct").alias("pct"),
            F.count("disponibilidade_pct").alias("pct_n"),
            *[_total(c).alias(c) for c in SERVER_SUMS],
        )
    )
    owners = warehouse.read("dim_servidor").select("sk_servidor", "sk_cliente")
    clients = warehouse.read("dim_cliente").select("sk_cliente", "nm_cliente")
    servers = (
        per_server.join(_sized(owners), "sk_servidor", "left")
        .groupBy("anomes", "sk_cliente")
        .agg(F.count(F.lit(1)).alias("servers"), _total("pct").alias("pct"), _total("pct_n").alias("pct_n"),
             *[_total(c).alias(c) for c in SERVER_SUMS])
        .join(_sized(clients), "sk_cliente", "left")
        .groupBy(*group)
        .agg(*[_total(c).alias(c) for c in ("servers", "pct", "pct_n", *SERVER_SUMS)])
    )
    # At most one row of each fact for a group, so the greatest is that row's value.
    united = tickets.unionByName(servers, allowMissingColumns=True)
    both = united.groupBy(*group).agg(*[F.max(c).alias(c) for c in united.columns if c not in group])

    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    mart = both.select(
        *group,
        zero("n").alias("total_tickets"),
        zero("checklists").alias("qtd_checklists"),
        zero("csi").alias("qtd_csi"),
        zero("crises").alias("qtd_crises"),
        F.col("acted").alias("tickets_atuados"),
        exact_mean(F.col("hours"), F.col("timed")).alias("tempo_medio_resolucao_horas"),
        zero("servers").alias("qtd_servidores_monitorados"),
        exact_mean(F.col("pct"), F.col("pct_n")).alias("disponibilidade_media_pct"),
        F.col("minutos_indisponiveis").alias("total_minutos_indisponiveis"),
        F.col("tamanho_gb").cast("decimal(38,2)").alias("volumetria_total_gb"),
        F.col("delta_1_mes").cast("decimal(38,2)").alias("crescimento_total_mes_gb"),
    )
    return ordered_mart(mart, *group) if ordered else mart


MARTS = {
    "vw_executiva": executive_summary,
    "vw_tecnica": star_detail_left,
    "vw_executiva_disponibilidade_capacity": star_detail_inner,
    "vw_csi_melhorias": star_detail_csi,
    "vw_indicadores": ticket_indicators,
    "vw_tecnica_completa": bridge_join,
    "vw_tecnica_completa_mes": bridge_join_fixed,
}


def publish_marts(warehouse: Warehouse, prefix: str = "") -> dict[str, DataFrame]:
    """The six marts as temporary views, and beside the full technical one its reading with the ticket's month only."""
    marts = {name: build(warehouse) for name, build in MARTS.items()}
    for name, df in marts.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return marts
