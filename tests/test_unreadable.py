import json

import pytest

from pyspark.sql import functions as F

from deskstar.plans import facts
from deskstar.plans.refine import build_curated_tickets, build_curated_tickets_legacy, build_staging_tickets
from deskstar.sources.raw import read_raw_monitoring, read_raw_tickets
from deskstar.sources.warehouse import Warehouse


def test_unreadable_tickets(spark, tmp_path):
    good = json.dumps([{"id": "7", "status": "2", "subject": "s"}, {"id": 8, "status": 2}])
    path = tmp_path / "t.json"
    path.write_text(good)
    assert {(r.id, r.status) for r in read_raw_tickets(spark, str(path)).collect()} == {(7, "2"), (8, "2")}
    path.write_text(good + '\n[{"id": 9, "status": 2}, {"id": 10, "sta\n[{"id": "x", "status": 2}, {"id": 11, "status": "y"}]\n')
    with pytest.raises(Exception, match="unreadable"):
        read_raw_tickets(spark, str(path)).collect()
    wh = Warehouse(spark, str(tmp_path / "dw"))
    rows = read_raw_tickets(spark, str(path), mode="quarantine", warehouse=wh).collect()
    assert {(r.id, r.status) for r in rows} == {(7, "2"), (8, "2"), (11, "y")}
    kept = {(r.motivo, json.loads(r.linha).get("_corrupt_record")) for r in wh.rejected("raw_tickets").collect()}
    assert kept == {("unreadable: line", '[{"id": 9, "status": 2}, {"id": 10, "sta'), ("unreadable: id", None)}


def test_a_strict_read_fails_whatever_is_selected(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('[{"id": 1, "subject": "a"}]\n[{"id": 2, "subj\n')
    rows = read_raw_tickets(spark, str(path))
    for df in (rows.select("subject"), rows.select(F.lit(1)), rows.groupBy().count()):
        with pytest.raises(Exception, match="unreadable"):
            df.collect()
    with pytest.raises(Exception, match="unreadable"):
        rows.count()


def test_a_status_in_words_reaches_the_curated_layers(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps([{"id": 1, "subject": "s", "status": " Aberto "}, {"id": 2, "subject": "s", "status": 5},
                                {"id": 3, "subject": "s", "status": "5"}, {"id": 4, "subject": "s"}, {"id": 5, "subject": "s", "status": 99}]))
    staging = build_staging_tickets(read_raw_tickets(spark, str(path)))
    found = {r.id_ticket: r.status_ticket for r in build_curated_tickets(staging).collect()}
    assert found == {1: "Aberto", 2: "Fechado", 3: "Fechado", 4: "Outros", 5: "Outros"}
    legacy = {r.id_ticket: r.status_ticket for r in build_curated_tickets_legacy(staging).collect()}
    assert (legacy[1], legacy[2], legacy[4]) == ("aberto", "fechado", "")


SERVERS = ("INSTANCIA string, HOST_NAME string, ANOMES string, TAMANHO_GB string, DELTA_1_MES string, DELTA_2_MESES string, "
           "DELTA_3_MESES string, DELTA_6_MESES string, DELTA_12_MESES string, DISPONIBILIDADE_PCT string, MINUTOS_INDISPONIVEIS string")


def test_every_server_row_is_stored_or_rejected(spark, tmp_path):
    rows = [("A", None, "202401", *["1"] * 8), ("B", None, "202613", *["1"] * 8), (" ", "", "202401", *["1"] * 8), ("C", None, "x", *["1"] * 8)]
    df = spark.createDataFrame(rows, SERVERS)
    wh = Warehouse(spark, str(tmp_path / "dw"))
    with pytest.raises(Exception, match="invalid value"):
        facts.load_fato_servidor(wh, df, mode="strict")
    strict = df.where("ANOMES = '202401'")
    other = Warehouse(spark, str(tmp_path / "strict"))
    assert facts.load_fato_servidor(other, strict, mode="strict").count() == 1
    assert [r.motivo for r in other.rejected("fato_servidor").collect()] == ["NK_SERVIDOR"]
    assert facts.load_fato_servidor(wh, df, mode="quarantine").count() == 1
    kept = {(r.chave.split("|")[-1], r.motivo) for r in wh.rejected("fato_servidor").collect()}
    assert kept == {("202401", "NK_SERVIDOR"), ("202613", "ANOMES"), ("x", "ANOMES")}
    flat = facts.load_flat_servers(wh, df, mode="quarantine")
    assert flat.count() == 2 and wh.rejected("fato_servidores_mensal").count() == 2


def test_truncated_monitoring_fails(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('{"instancia": "A", "results": [{"items": [{"anomes": "01/2026"}]}]}\n{"instancia": "B", "results": [{"items": [{"anomes": "01/20')
    with pytest.raises(Exception, match="no results"):
        read_raw_monitoring(spark, str(path), "availability").collect()
