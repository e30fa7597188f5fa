"""Parts of the star are built when asked for, and loads compute their input once."""

from __future__ import annotations

import os

from deskstar import bindings as b
from deskstar import schemas
from deskstar.operators import joins, members
from deskstar.plans import dimensions, facts, marts
from deskstar.sources.warehouse import Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_layers_are_read_without_loading_a_table(spark, sf_dir):
    star = b.Star(spark, sf_dir)
    assert star.curated.count() > 0
    assert not os.path.exists(f"{star._root}/dw")


def test_ticket_dimensions_load_no_fact(spark, sf_dir):
    star = b.Star(spark, sf_dir)
    warehouse = star.ticket_dimensions
    assert warehouse.read("dim_tempo").count() > 0
    assert not any(os.path.exists(warehouse.path(table)) for table in ("fato_ticket", "fato_csi", "fato_servidor"))


def test_names_and_days_are_read_from_distinct_values(spark):
    rows = [(" a ", "2024-01-02"), ("a", "2024-01-02T10:00:00Z"), ("", "x"), (None, None), ("B", "2024-01-03")]
    df = spark.createDataFrame(rows, "nome string, dia string")
    names, days = members.distinct_members(df, "nome", "n", default="?"), members.union_dates(df, ["dia", "dia"])
    assert sorted(r[0] for r in names.collect()) == ["?", "B", "a"]
    assert sorted(str(r[0]) for r in days.collect()) == ["2024-01-02", "2024-01-03"]
    assert plan(names).count("Aggregate") == plan(days).count("Aggregate") == 2


def ticket(i, **values):
    row = dict.fromkeys(schemas.CURATED_TICKETS.names)
    return {**row, "id_ticket": i, "nk_servidor": "S1", "nome_servidor": "S1", **values}


def test_the_first_of_equal_servers_is_kept(spark):
    rows = [
        ticket(3, empresa="B", instancia="I3"), ticket(2, empresa="A", instancia="I2"), ticket(1, empresa=" A", instancia=" I1"),
        ticket(1, empresa=" A", instancia=" I1"), ticket(None, empresa="A ", instancia="I0"), ticket(4, nk_servidor=" "),
    ]
    servers = dimensions.server_members(spark.createDataFrame(rows, schemas.CURATED_TICKETS))
    assert [(r["nk_servidor"], r["instancia"], r["empresa"]) for r in servers.collect()] == [("S1", "I0", "A")]
    # Tickets with the same attributes are folded before the text work.
    assert "Aggregate" in plan(servers)


def test_server_loads_read_their_staging_once(spark, tmp_path, sf_dir):
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    prepared = facts.prepare_servers(b.staging_servers(spark, sf_dir), "strict", warehouse)
    assert all("servers-dated" in file for file in prepared.inputFiles())


def test_quarantined_facts_look_their_keys_up_once(spark, tmp_path, sf_dir, monkeypatch):
    star, labels, stage = b.star(spark, sf_dir), [], Warehouse.stage
    monkeypatch.setattr(Warehouse, "stage", lambda self, df, label: labels.append(label) or stage(self, df, label))
    warehouse = Warehouse(spark, str(tmp_path / "dw"))
    dimensions.load_dimensions(warehouse, star.curated)
    facts.load_fato_csi(warehouse, star.curated, "quarantine", b.load_ts())
    assert "fato_csi-keyed" in labels


def test_tickets_are_not_shuffled_for_the_few_hosts_of_the_bridge(spark, sf_dir, monkeypatch):
    warehouse = b.star(spark, sf_dir).warehouse
    whole = sorted(map(str, marts.bridge_join(warehouse).collect()))
    # As for a fact of servers beyond the checked size: only the bridge and the dimensions count as small.
    looked_up, real = [], joins.small
    monkeypatch.setattr(joins, "small", lambda df, limit=joins.BROADCAST_LIMIT: limit > joins.BROADCAST_LIMIT or (
        not {"tamanho_gb"} & set(df.columns) and real(df, limit)))
    monkeypatch.setattr(joins, "hot_keys", lambda *a: looked_up.append(a) or {})
    assert sorted(map(str, marts.bridge_join(warehouse).collect())) == whole and not looked_up
    monkeypatch.setattr(marts, "BRIDGED_ROWS", 0)
    assert sorted(map(str, marts.bridge_join(warehouse).collect())) == whole and looked_up
