"""A month whose servers come from a staged file, in both generations."""

import json

import pytest

from deskstar.plans.monthly import MonthlyInputs, run_month, run_month_legacy
from deskstar.sources.warehouse import Warehouse

HEADER = "INSTANCIA;HOST_NAME;ANOMES;TAMANHO_GB;DELTA_1_MES;DELTA_2_MESES;DELTA_3_MESES;DELTA_6_MESES;DELTA_12_MESES;DISPONIBILIDADE_PCT;MINUTOS_INDISPONIVEIS"
ROWS = ["ECP;srv-1;202601;1000.5;1;;;;;97.5;30", "ECP;srv-1;202601;9;9;9;9;9;9;9;9", "BW;;202601;x;;;;;;100;0", ";;202601;1;1;1;1;1;1;1;1",
        "QAS;srv-2;202613;1;1;1;1;1;1;1;1"]


@pytest.fixture
def landed(tmp_path):
    ticket = {"id": 10, "pos": 0, "page": 1, "window_start": "2026-01-01", "company_id": 72000664348, "status": 5,
              "subject": "ALERT: Server: srv-1 (ecp)", "created_at": "2026-01-02T10:00:00Z", "updated_at": "2026-01-02T12:30:00Z"}
    (tmp_path / "tickets.json").write_text(json.dumps([ticket]))
    (tmp_path / "servidores_20260201_101500.csv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    return MonthlyInputs(str(tmp_path / "tickets.json"), servers=str(tmp_path / "servidores_20260201_101500.csv"))


def test_staged_servers_reach_the_star(spark, tmp_path, landed):
    wh = Warehouse(spark, str(tmp_path / "dw"))
    run_month(spark, str(tmp_path / "lake"), wh, 2026, 1, landed, mode="quarantine")
    names = {r.sk_servidor: r.nk_servidor for r in wh.read("dim_servidor").collect()}
    rows = sorted((names[r.sk_servidor], str(r.tamanho_gb), r.minutos_indisponiveis, r.arquivo_origem.rsplit("/", 1)[1])
                  for r in wh.read("fato_servidor").collect())
    file = "servidores_20260201_101500.csv"
    # The first row of a server and month wins in file order; the others are its repeat and two rejects.
    assert [r[1:] for r in rows] == [("None", 0, file), ("1000.50", 30, file)]
    assert sorted(r.motivo for r in wh.rejected("fato_servidor").collect()) == ["ANOMES", "NK_SERVIDOR"]


def test_staged_servers_reach_the_flat_tables(spark, tmp_path, landed):
    wh = Warehouse(spark, str(tmp_path / "dw"))
    run_month_legacy(spark, str(tmp_path / "lake"), wh, 2026, 1, landed, mode="quarantine")
    assert [r.id_ticket for r in wh.read("fato_tickets").collect()] == [10]
    assert sorted((r.instancia or "", str(r.tamanho_gb)) for r in wh.read("fato_servidores_mensal").collect()) == [
        ("", "1.00"), ("BW", "None"), ("ECP", "1000.50")]
    assert [r.motivo for r in wh.rejected("fato_servidores_mensal").collect()] == ["ANOMES"]


def test_refused_inputs(spark, tmp_path, landed):
    with pytest.raises(ValueError, match="either"):
        MonthlyInputs("x", volumetry="v", servers="s")
    (tmp_path / "short.csv").write_text("INSTANCIA,HOST_NAME\nA,B\n")
    inputs = MonthlyInputs(landed.tickets, servers=str(tmp_path / "short.csv"))
    with pytest.raises(ValueError, match="ANOMES"):
        run_month(spark, str(tmp_path / "lake"), Warehouse(spark, str(tmp_path / "dw")), 2026, 1, inputs, mode="quarantine")
