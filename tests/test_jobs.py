"""Loads and marts as a whole."""

import itertools
import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from deskstar import bindings as b
from deskstar import schemas
from deskstar.operators import quality
from deskstar.plans import dimensions, facts, marts
from deskstar.plans.monthly import MonthlyInputs, run_month
from deskstar.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def star(spark, sf_dir):
    return b.star(spark, sf_dir)


def table(df, *drop):
    return sorted((repr(tuple(r)) for r in df.drop(*drop).collect()))


def test_constraints_hold(star):
    tables = {t: star.warehouse.read(t) for t in schemas.STAR_TABLES}
    assert all(r.violacoes == 0 for r in quality.check_constraints(tables).collect())
    assert all(r.linhas_excedentes == 0 for r in quality.check_unique(tables).collect())
    assert all(r.orfaos == 0 and r.nulos_indevidos == 0 for r in quality.check_foreign_keys(tables).collect())


def test_loading_twice_changes_nothing(spark, star, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    seen = []
    for _ in range(2):
        dimensions.load_dimensions(wh, star.curated)
        facts.load_fato_ticket(wh, star.curated, "strict", b.load_ts())
        facts.load_fato_csi(wh, star.curated, "quarantine", b.load_ts())
        seen.append([table(wh.read(t), "sk_ticket", "sk_fato_csi") for t in schemas.STAR_TABLES if wh.exists(t)])
    assert seen[0] == seen[1]


def test_blank_improvement_status_aborts_the_strict_load(spark, star, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    dimensions.load_dimensions(wh, star.curated)
    with pytest.raises(Exception, match="unresolved sk_status_csi"):
        facts.load_fato_csi(wh, star.curated, "strict")
    assert not wh.exists("fato_csi")


def test_executive_mart_equals_the_product(star):
    """Every ticket of a day paired with every server row of the day, one pair after the other."""
    read = lambda table: [r.asDict() for r in star.warehouse.read(table).collect()]
    clients = {r["sk_cliente"]: r["nm_cliente"] for r in read("dim_cliente")}
    kinds = {r["sk_tipo_ticket"]: r["nm_tipo_ticket"] for r in read("dim_tipo_ticket")}
    tickets, servers, groups = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in read("fato_ticket"):
        tickets[r["sk_tempo_criacao"]].append(r)
    for r in read("fato_servidor"):
        servers[r["sk_tempo_referencia"]].append(r)
    for day in tickets.keys() | servers.keys():
        for t, s in itertools.product(tickets[day] or [{}], servers[day] or [{}]):
            groups[day // 100, clients.get(t.get("sk_cliente"))].append((t, s))

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    expected = sorted(repr((
        *group, len({t["id_ticket_origem"] for t, _ in rows if t}), sum(kinds.get(t.get("sk_tipo_ticket")) == "CSI" for t, _ in rows),
        total(t.get("foi_atuado") for t, _ in rows), len({s["sk_servidor"] for _, s in rows if s}),
        total(s.get("minutos_indisponiveis") for _, s in rows), total(s.get("tamanho_gb") for _, s in rows)))
        for group, rows in groups.items())
    columns = ("anomes", "nm_cliente", "total_tickets", "qtd_csi", "tickets_atuados", "qtd_servidores_monitorados",
               "total_minutos_indisponiveis", "volumetria_total_gb")
    assert table(marts.executive_summary(star.warehouse).select(*columns)) == expected


def test_fixed_mart_adds_up_to_the_facts(star):
    mart = marts.executive_summary_fixed(star.warehouse).agg(
        F.sum("total_tickets"), F.sum("tickets_atuados"), F.sum("volumetria_total_gb"), F.sum("total_minutos_indisponiveis")).first()
    tickets = star.warehouse.read("fato_ticket").agg(F.count("*"), F.sum("foi_atuado")).first()
    servers = star.warehouse.read("fato_servidor").agg(F.sum("tamanho_gb"), F.sum("minutos_indisponiveis")).first()
    assert tuple(mart) == (*tickets, *servers)


def test_month_out_of_range(spark, tmp_path):
    with pytest.raises(ValueError, match="month"):
        run_month(spark, str(tmp_path), Warehouse(spark, str(tmp_path)), 2024, 13, MonthlyInputs("x"))


def test_two_months_end_to_end(spark, tmp_path):
    """Hand-written tickets through the whole run, with the default dictionaries."""
    wh, lake = Warehouse(spark, str(tmp_path / "dw")), str(tmp_path / "lake")
    ticket = {"company_id": 72000664348, "status": 5, "window_start": "2026-01-01", "page": 1, "custom_fields": {"cf_ambiente": "prd"}}
    months = {
        1: [{**ticket, "id": 10, "pos": 0, "subject": "ALERT: Mills - Server: srv-01 (ecp)", "created_at": "2026-01-02T10:00:00Z", "updated_at": "2026-01-02T12:30:00Z"},
            {**ticket, "id": 10, "pos": 1, "subject": "repetido", "created_at": "2026-01-02T10:00:00Z", "updated_at": None}],
        2: [{**ticket, "id": 11, "pos": 0, "company_id": 1, "subject": "CSI  melhoria", "created_at": "2026-02-03T00:00:00Z",
             "updated_at": "2026-02-03T00:00:00Z", "custom_fields": {"cf_csi_status": "Aberto"}}],
    }
    vol = {"results": [{"items": [{"db": "ECP", "mes": "01/2026", "gb_total": "1 000.5", "diff_1m": 120}]}]}
    disp = {"instancia": "ECP", "results": [{"items": [{"anomes": "1/2026", "disponibilidade_pct": "97.5", "minutos_indisponiveis": 30}]}]}
    for name, doc in (("vol", vol), ("disp", disp)):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    for month, tickets in months.items():
        landed = tmp_path / f"t{month}.json"
        landed.write_text(json.dumps(tickets))
        feeds = (str(tmp_path / "vol.json"), str(tmp_path / "disp.json")) if month == 1 else (None, None)
        run_month(spark, lake, wh, 2026, month, MonthlyInputs(str(landed), *feeds))
    detail = {r.id_ticket_origem: r for r in marts.star_detail_left(wh).collect()}
    assert (detail[10].nm_cliente, detail[10].nm_tipo_ticket, detail[10].titulo_ticket) == ("MILLS", "Incidente", "Mills - Server: srv-01 (ecp)".removeprefix("Mills - "))
    assert (detail[10].nk_servidor, detail[10].instancia, detail[10].ambiente_macro, str(detail[10].tempo_resolucao_horas)) == ("SRV-01", "ECP", "Produção", "2.50")
    assert (detail[11].nm_cliente, detail[11].foi_atuado) == ("NÃO IDENTIFICADO", 0)
    csi = marts.star_detail_csi(wh).collect()
    assert [(r.id_ticket_origem, r.nm_cliente, r.nm_status_csi, r.titulo_csi) for r in csi] == [(11, None, "aberto", "CSI melhoria")]
    capacity = marts.star_detail_inner(wh).collect()
    assert [(r.nk_servidor, str(r.tamanho_gb), r.status_disponibilidade, r.status_capacity) for r in capacity] == [("ECP", "1000.50", "Crítico", "Crescimento elevado")]
    wh.append(spark.createDataFrame([("ECP", "H")], schemas.TABLE["map_servidor_instancia"]), "map_servidor_instancia")
    marts.publish_marts(wh, "m_")
    assert spark.table("m_vw_tecnica_completa").count() == 2
