"""Tickets and monitoring feeds as projections of general-purpose tables.

The tables hold events and order lines, not tickets and servers. An event becomes a raw ticket and the
order lines of a supplier in a month become the monitoring of one server in that month. Customer
names are stand-ins, so the customer dictionary is passed to the operators as a parameter.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskstar.functions.temporal import month_key
from deskstar.functions.text import normalise_text
from deskstar.operators.capacity import capacity_deltas, window_start
from deskstar.plans.dimensions import load_dimensions
from deskstar.plans.facts import load_fato_csi, load_fato_servidor, load_fato_ticket
from deskstar.plans.refine import (
    ORDER,
    build_curated_tickets,
    build_staging_servers,
    build_staging_tickets,
)
from deskstar.session import fresh_path, prepare
from deskstar.sources.layers import layer_path, write_layer
from deskstar.sources.raw import dedupe_landed_pages
from deskstar.sources.warehouse import Warehouse

CODES = {0: "AAA", 1: "BBB", 2: "CCC", 3: "DDD"}
PATTERNS = tuple((name, rf"\b{name}\b") for name in CODES.values())
NAMES_LEGACY = {0: "Aaa", 1: "Bbb", 2: "Ccc do Rio", 3: "Ddd"}
ALIASES_LEGACY = {"AAA": "AAA", "BBB": "BBB", "CCC DO RIO": "CCC", "CCC": "CCC"}
DICTIONARIES = {"codes": CODES, "patterns": PATTERNS, "title_customers": tuple(CODES.values())}
LEGACY_DICTIONARIES = {
    "names": NAMES_LEGACY, "aliases": ALIASES_LEGACY, "title_customers": ("AAA", "BBB"),
}
LOAD_TS = "2024-02-01 00:00:00"
SOURCE = "servidores_staging_20240201_000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_ts() -> Column:
    return F.lit(LOAD_TS).cast("timestamp")


def _pick(index: Column, *values: str | None) -> Column:
    """The value at a zero-based index."""
    out = F.lit(None).cast("string")
    for i, value in enumerate(values):
        out = F.when(index == i, F.lit(value)).otherwise(out)
    return out


def ticket_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ticket, before nesting and without repeated pages."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", k.alias("k")
    )
    k = F.col("k")
    server = F.concat(F.lit("SRV-"), F.lpad((F.col("user_id") % 40).cast("string"), 3, "0"))
    db = (k % 7).cast("string")
    kind = F.col("event_type")
    subject = (
        F.when(kind == "error", F.concat(F.lit("ALERT: Server: "), server, F.lit(" (DB"), db, F.lit(") Oracle down")))
        .when(kind == "signup", F.concat(F.lit("CSI -  melhoria  INSTÂNCIA: "), server))
        .when(kind == "purchase", F.concat(F.lit("INFO daily: Health Check BBB (db"), db, F.lit(")")))
        .when(kind == "click", F.concat(server, F.lit(" - crise no postgres")))
        .otherwise(F.lit("AAA - pedido geral"))
    )
    csi = F.when(kind == "signup", _pick(k % 4, " Implementado ", "Aberto", "NA", None))
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (k - 20) * 37)
    day = F.to_date("ts")
    return events.select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % 6).alias("company_id"),
        subject.alias("subject"),
        F.when(k % 10 != 9, k % 10).alias("status"),
        (k % 4 + 1).alias("priority"),
        _pick(k % 7, "csi", " Checklist ", "Incidente", "incidentes", "CRISE", "Pedido", None).alias("type"),
        F.col("ts").alias("created_at"),
        F.when(k % 17 != 0, F.col("ts") + minutes).alias("updated_at"),
        F.when(k % 5 == 0, "Oracle").alias("cf_sgdb"),
        _pick(k % 6, "prd", "HML", "qa", "Outros", None, "Lab").alias("cf_ambiente"),
        csi.alias("cf_csi_status"),
        window_start(day).alias("window_start"),
        F.lit(1).alias("page"),
        F.col("event_id").alias("pos"),
    )


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw tickets as landed; every fiftieth id comes again, changed, on page 2."""
    pages = F.when(F.col("id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    seen = ticket_events(spark, sf_dir).withColumn("page", F.explode(pages))
    landed = seen.withColumn("status", F.when(F.col("page") == 2, 5).otherwise(F.col("status")))
    nested = F.struct("cf_sgdb", "cf_ambiente", "cf_csi_status").alias("custom_fields")
    return landed.select(
        "id", "company_id", "subject", F.col("status").cast("string").alias("status"), "priority", "type",
        _iso(F.col("created_at")).alias("created_at"), _iso(F.col("updated_at")).alias("updated_at"),
        nested, "window_start", "page", "pos",
    )


def staging_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen tickets as staging rows, with their order and month."""
    landed = ("window_start", "page", "pos")
    first = dedupe_landed_pages(raw_pages(spark, sf_dir))
    placed = first.withColumns(
        {ORDER: F.struct(*landed), "anomes": month_key(F.col("window_start"))}
    )
    return build_staging_tickets(placed.drop(*landed))


def curated_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_curated_tickets(staging_tickets(spark, sf_dir), **DICTIONARIES)


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket subjects and whole prose texts: (origem, id, subject)."""
    tickets = ticket_events(spark, sf_dir).select(F.lit("ticket").alias("origem"), "id", "subject")
    docs = table(spark, sf_dir, "documents").select(
        F.lit("documento").alias("origem"), F.col("doc_id").alias("id"), F.col("text").alias("subject")
    )
    talks = table(spark, sf_dir, "conversations").select(
        F.lit("conversa").alias("origem"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("text").alias("subject"),
    )
    return tickets.unionAll(docs).unionAll(talks)


def prepared_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the trimmed and the lower-case text, each computed once per row."""
    trimmed = subjects(spark, sf_dir).withColumn("texto", normalise_text(F.col("subject")))
    return trimmed.withColumn("minusculo", F.lower("texto"))


# --- monitoring ------------------------------------------------------------------------------------
def _server_months(spark: SparkSession, sf_dir: str, flags: tuple[str, ...] | None) -> DataFrame:
    """Order lines with one of the flags; without flags, all of them."""
    shifted = F.add_months(F.to_date("l_shipdate"), 28 * 12)
    lines = table(spark, sf_dir, "lineitem")
    return (lines if flags is None else lines.where(F.col("l_returnflag").isin(*flags))).select(
        "l_suppkey",
        month_key(shifted).alias("ANOMES"),
        "l_quantity",
    )


def server_name(key: str = "l_suppkey") -> Column:
    """Name of the server that a supplier stands for; different keys have different names."""
    return F.format_string("SRV-%03d", key)


def sizes(spark: SparkSession, sf_dir: str, flags: tuple[str, ...] | None = ("A", "N")) -> DataFrame:
    """Size per server and month, one row each."""
    return (
        _server_months(spark, sf_dir, flags).groupBy("l_suppkey", "ANOMES")
        .agg(F.sum("l_quantity").cast("decimal(14,2)").alias("TAMANHO_GB"))
        .select(server_name().alias("INSTANCIA"), "ANOMES", "TAMANHO_GB")
    )


def volumetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumetry feed rows; like the real feed it carries no two-month delta."""
    deltas = capacity_deltas(sizes(spark, sf_dir), "INSTANCIA", "ANOMES", "TAMANHO_GB", months=(1, 3, 6, 12))
    return deltas.select(
        "INSTANCIA", F.col("INSTANCIA").alias("HOST_NAME"), "ANOMES",
        *[F.col(c).cast("double").alias(c.upper()) for c in
          ("TAMANHO_GB", "delta_1_mes", "delta_3_meses", "delta_6_meses", "delta_12_meses")],
    )


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _server_months(spark, sf_dir, ("R",)).groupBy("l_suppkey", "ANOMES").agg(
        F.count(F.lit(1)).alias("n")
    )
    return grouped.select(
        server_name().alias("INSTANCIA"), server_name().alias("HOST_NAME"), "ANOMES",
        (100 - F.col("n") % 5).cast("double").alias("DISPONIBILIDADE_PCT"),
        (F.col("n") * 11).cast("int").alias("MINUTOS_INDISPONIVEIS"),
    )


def staging_servers(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return build_staging_servers(volumetry(spark, sf_dir), availability(spark, sf_dir), ordered)


# --- landed files -----------------------------------------------------------------------------------
PAGE_SIZE = 100


def land_ticket_pages(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Raw tickets as JSON lines, each line an array of at most ``PAGE_SIZE`` tickets per window and page."""
    pages = raw_pages(spark, sf_dir).withColumn("status", F.col("status").cast("int")).withColumn("_page", F.floor(F.col("pos") / PAGE_SIZE))
    ticket = F.struct(*[c for c in pages.columns if c != "_page"])
    lines = pages.groupBy("window_start", "page", "_page").agg(F.collect_list(ticket).alias("tickets"))
    lines.select(F.to_json("tickets").alias("value")).write.text(path)
    return path


def land_monitoring(spark: SparkSession, sf_dir: str, path: str) -> tuple[str, str]:
    """One document per server and feed; a document holds the months of one server."""
    month = F.concat(
        F.lpad((F.col("ANOMES") % 100).cast("string"), 2, "0"), F.lit("/"),
        F.floor(F.col("ANOMES") / 100).cast("string"),
    )

    def land(feed: DataFrame, name: str, fields: dict[str, Column]) -> str:
        item = F.struct(*[c.cast("string").alias(n) for n, c in fields.items()])
        docs = feed.groupBy("INSTANCIA").agg(F.sort_array(F.collect_list(item)).alias("items"))
        doc = F.struct(
            F.col("INSTANCIA").alias("instancia"), F.col("INSTANCIA").alias("host_name"),
            F.array(F.struct("items")).alias("results"),
        )
        docs.select(F.to_json(doc).alias("value")).write.text(f"{path}/{name}")
        return f"{path}/{name}"

    vol = land(
        volumetry(spark, sf_dir), "volumetria",
        {"db": F.col("INSTANCIA"), "mes": month, "gb_total": F.col("TAMANHO_GB"),
         "diff_1m": F.col("DELTA_1_MES"), "diff_3m": F.col("DELTA_3_MESES"),
         "diff_6m": F.col("DELTA_6_MESES"), "diff_12m": F.col("DELTA_12_MESES")},
    )
    disp = land(
        availability(spark, sf_dir), "disponibilidade",
        {"anomes": month, "disponibilidade_pct": F.col("DISPONIBILIDADE_PCT"),
         "minutos_indisponiveis": F.col("MINUTOS_INDISPONIVEIS")},
    )
    return vol, disp


# --- the star ----------------------------------------------------------------------------------------
def bridge(warehouse: Warehouse) -> DataFrame:
    """Instance to physical host, from the stored servers: DBj runs on SRV-00j."""
    instance = F.col("instancia")
    return (
        warehouse.read("dim_servidor").where(instance.rlike("^DB[0-9]$")).select(instance).distinct()
        .withColumn("host_name", F.concat(F.lit("SRV-00"), F.substring("instancia", 3, 1)))
    )


def load_facts(warehouse: Warehouse, curated: DataFrame, servers: DataFrame) -> None:
    """The three facts and the bridge, after the dimensions of the tickets."""
    load_fato_ticket(warehouse, curated, "quarantine", load_ts())
    load_fato_csi(warehouse, curated, "quarantine", load_ts())
    load_fato_servidor(warehouse, servers, SOURCE, "strict", load_ts())
    warehouse.append(bridge(warehouse), "map_servidor_instancia")


def load_star(warehouse: Warehouse, curated: DataFrame, servers: DataFrame) -> None:
    """Dimensions, the three facts and the bridge."""
    load_dimensions(warehouse, curated)
    load_facts(warehouse, curated, servers)


class Star:
    """Lake and warehouse of a data folder, built once; each part is built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._root = fresh_path(spark, "star")

    @cached_property
    def staging(self) -> DataFrame:
        root = f"{self._root}/lake"
        write_layer(staging_tickets(self._spark, self._sf_dir), root, "staging", "tickets")
        return self._spark.read.parquet(layer_path(root, "staging", "tickets"))

    @cached_property
    def lake(self) -> str:
        """Folder of the two layers."""
        root = f"{self._root}/lake"
        write_layer(build_curated_tickets(self.staging, **DICTIONARIES), root, "curated", "tickets")
        return root

    @cached_property
    def curated(self) -> DataFrame:
        return self._spark.read.parquet(layer_path(self.lake, "curated", "tickets"))

    @cached_property
    def ticket_dimensions(self) -> Warehouse:
        """The warehouse once its dimensions hold the members of the tickets, whether or not its facts are loaded."""
        warehouse = Warehouse(self._spark, f"{self._root}/dw")
        load_dimensions(warehouse, self.curated)
        return warehouse

    @cached_property
    def warehouse(self) -> Warehouse:
        """The whole star."""
        load_facts(self.ticket_dimensions, self.curated, staging_servers(self._spark, self._sf_dir))
        return self.ticket_dimensions


_stars: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = Star(spark, sf_dir)
    return _stars[key]
