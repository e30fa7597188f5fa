"""Readers, contracts and layers."""

import json

import pytest
from pyspark.sql import functions as F

from deskstar import schemas
from deskstar.operators.dedupe import keep_first
from deskstar.plans.refine import build_staging_servers, build_staging_tickets
from deskstar.sources import contracts, layers, raw, warehouse


def test_pretty_printed_array(spark, tmp_path):
    tickets = [{"id": 1, "subject": "a", "custom_fields": {"cf_sgdb": "x"}}, {"id": 2}]
    (tmp_path / "m.json").write_text(json.dumps(tickets, indent=2))
    df = raw.read_raw_tickets(spark, str(tmp_path / "m.json"), multi_line=True)
    staging = build_staging_tickets(df)
    assert staging.columns == schemas.STAGING_TICKETS.names
    assert [tuple(r) for r in staging.orderBy("id").select("id", "`custom_fields.cf_sgdb`", "status").collect()] == [(1, "x", None), (2, None, None)]


def test_arrays_per_line_keep_file_order(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 7, "status": 1}, {"id": 7, "status": 2}]\n[{"id": 7, "status": 3}, {"id": 8}]\n')
    df = raw.read_raw_tickets(spark, str(tmp_path), order_col="ordem")
    first = keep_first(df, ["id"], [F.col("ordem")])
    assert {r.id: r.status for r in first.collect()} == {7: "1", 8: None}


def test_monitoring_documents(spark, tmp_path):
    doc = {"results": [{"items": [{"anomes": "04/2026", "disponibilidade_pct": 99.5, "minutos_indisponiveis": "12"}, {"anomes": "x"}]}]}
    (tmp_path / "ok.json").write_text(json.dumps(doc, indent=1))
    df = raw.read_raw_monitoring(spark, str(tmp_path / "ok.json"), "availability", "ECP", "H1", multi_line=True)
    assert [tuple(r)[:6] for r in df.orderBy("pos").collect()] == [("ECP", "H1", 202604, 99.5, 12, 0), ("ECP", "H1", None, None, None, 1)]
    (tmp_path / "bad.json").write_text('{"results": []}')
    with pytest.raises(Exception, match="no results"):
        raw.read_raw_monitoring(spark, str(tmp_path / "bad.json"), "availability", "ECP", "H1").collect()


def test_one_feed_only(spark):
    feed = spark.createDataFrame([("A", "H", 202401, 97.0, 3)], "INSTANCIA string, HOST_NAME string, ANOMES int, DISPONIBILIDADE_PCT double, MINUTOS_INDISPONIVEIS int")
    out = build_staging_servers(None, feed)
    assert out.columns == schemas.STAGING_SERVERS.names and out.first().TAMANHO_GB is None


@pytest.mark.parametrize("sep", [",", ";"])
def test_delimited(spark, tmp_path, sep):
    (tmp_path / "f.csv").write_text(sep.join(["id", "t"]) + "\n" + sep.join(["1", '"a ""b""\nc"']) + "\n" + sep.join(["x", "NA"]) + "\n")
    df = layers.read_delimited_auto(spark, str(tmp_path / "f.csv"), schemas.columns("id BIGINT, t STRING"), null_value="NA")
    assert [tuple(r) for r in df.orderBy(F.col("id").desc()).collect()] == [(1, 'a "b"\nc'), (None, None)]


def test_contracts(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    with pytest.raises(contracts.ContractError, match="c"):
        contracts.require_columns(df, ["a", "c"])
    with pytest.raises(contracts.ContractError):
        contracts.contract_check(df, schemas.columns("a INT, c INT"))
    report = {r.coluna: (r.presente, r.preenchidos, r.invalidos) for r in contracts.contract_check(df, schemas.columns("a INT, b INT")).collect()}
    assert report == {"a": (True, 1, 0), "b": (True, 1, 1)}


def test_write_layer_keeps_other_months(spark, tmp_path):
    root = str(tmp_path)
    layers.write_layer(spark.createDataFrame([(1, 202401), (2, 202402)], "v int, anomes int"), root, "curated", "x")
    layers.write_layer(spark.createDataFrame([(9,)], "v int"), root, "curated", "x", 202401)
    assert sorted(tuple(r) for r in layers.read_layer(spark, root, "curated", "x").collect()) == [(2, 202402), (9, 202401)]
    pruned = layers.read_layer(spark, root, "curated", "x", 202401)
    assert "PartitionFilters: [isnotnull(anomes" in pruned._jdf.queryExecution().toString()


def test_declare_and_drop(spark, tmp_path):
    wh = warehouse.Warehouse(spark, str(tmp_path / "dw"))
    wh.append(spark.createDataFrame([(1, "a", True)], "sk_cliente bigint, nm_cliente string, ativo boolean"), "dim_cliente")
    warehouse.create_star(spark, wh.root, "dw_test")
    assert spark.table("dw_test.dim_cliente").count() == 1
    spark.sql("CREATE TABLE dw_test.temporaria (a int) USING parquet")
    warehouse.drop_star(spark, "dw_test")
    assert [r.tableName for r in spark.sql("SHOW TABLES IN dw_test").collect() if not r.isTemporary] == ["temporaria"]
    spark.sql("DROP TABLE dw_test.temporaria")
    assert wh.read("dim_cliente").count() == 1
