"""Loads switch the catalogue to new files at their end: before that nothing shows, and nothing is lost."""

import pytest

from deskstar import bindings as b
from deskstar import schemas
from deskstar.operators import upserts
from deskstar.plans import dimensions, facts
from deskstar.sources import warehouse
from deskstar.sources.warehouse import Warehouse

TICKETS = "id_ticket_origem bigint, sk_tempo_criacao int, titulo_ticket string"


def tickets(spark, *rows):
    return spark.createDataFrame(list(rows), TICKETS)


def stored(wh, table="fato_ticket", *cols):
    return sorted(map(tuple, wh.read(table).select(*(cols or ("id_ticket_origem", "titulo_ticket", "sk_ticket"))).collect()))


@pytest.fixture
def loaded(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "dw"))
    upserts.upsert_by_id(wh, "fato_ticket", tickets(spark, (1, 20240105, "a"), (2, 20240210, "b"), (3, None, "c")), sk="sk_ticket")
    return wh


def broken(monkeypatch, name):
    def die(*args):
        raise KeyboardInterrupt("killed")

    monkeypatch.setattr(Warehouse, name, die)


def test_a_write_killed_before_the_switch_leaves_the_old_rows(spark, loaded, monkeypatch):
    before = stored(loaded)
    batch = tickets(spark, (1, 20240301, "novo"), (3, 20240210, "c2"), (4, 20240301, "d"))
    with monkeypatch.context() as m:
        broken(m, "_publish")
        with pytest.raises(KeyboardInterrupt):
            upserts.upsert_by_id(loaded, "fato_ticket", batch, sk="sk_ticket")
    assert stored(loaded) == before
    seen = []
    for _ in range(2):
        upserts.upsert_by_id(loaded, "fato_ticket", batch, sk="sk_ticket")
        seen.append(stored(loaded))
    keys = {i: k for i, _, k in before}
    assert seen[0] == seen[1] == [(1, "novo", keys[1]), (2, "b", keys[2]), (3, "c2", keys[3]), (4, "d", max(keys.values()) + 1)]


def test_switches_that_broke_off_are_repaired_as_a_whole(spark, loaded, monkeypatch):
    batch = tickets(spark, (1, 20240301, "novo"), (4, 20240105, "d"))
    with monkeypatch.context() as m:
        broken(m, "_switch")
        with pytest.raises(KeyboardInterrupt):
            upserts.upsert_by_id(loaded, "fato_ticket", batch, sk="sk_ticket")
    loaded.repair("fato_ticket")
    assert [r[:2] for r in stored(loaded)] == [(1, "novo"), (2, "b"), (3, "c"), (4, "d")]


def test_a_catalogue_that_forgot_is_set_up_from_the_folder(spark, loaded):
    upserts.upsert_by_id(loaded, "fato_ticket", tickets(spark, (2, 20240401, "moved")), sk="sk_ticket")
    loaded.append(spark.createDataFrame([(1, "a", True)], "sk_cliente bigint, nm_cliente string, ativo boolean"), "dim_cliente")
    loaded.append(spark.createDataFrame([(2, "b", True)], "sk_cliente bigint, nm_cliente string, ativo boolean"), "dim_cliente")
    before = stored(loaded)
    for table in ("fato_ticket", "dim_cliente"):
        spark.sql(f"DROP TABLE {loaded.name(table)}")
    again = Warehouse(spark, loaded.root)
    assert stored(again) == before and again.read("dim_cliente").count() == 2


def test_loads_after_the_declaration_show_in_the_catalogue(spark, sf_dir, tmp_path):
    curated = b.star(spark, sf_dir).curated
    root = str(tmp_path / "dw")
    warehouse.create_star(spark, root, "dw_declared")
    assert all(spark.table(f"dw_declared.{t}").count() == 0 for t in schemas.STAR_TABLES)
    wh = Warehouse(spark, root)
    assert wh.schema == "dw_declared" and not wh.exists("fato_ticket") and not wh.exists("dim_cliente")
    dimensions.load_dimensions(wh, curated)
    held = facts.load_fato_ticket(wh, curated, "strict", b.load_ts()).count()
    for table in ("fato_ticket", "dim_cliente", "dim_servidor"):
        assert spark.sql(f"SELECT count(*) FROM dw_declared.{table}").first()[0] == wh.read(table).count() > 0
    assert held == b.star(spark, sf_dir).warehouse.read("fato_ticket").count()
    with pytest.raises(ValueError, match="not below"):
        warehouse.create_star(spark, str(tmp_path / "other"), "dw_declared")
    warehouse.drop_star(spark, "dw_declared")
    assert wh.schema != "dw_declared" and wh.read("fato_ticket").count() == held


def test_a_killed_rewrite_of_a_dimension_keeps_its_rows_and_keys(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path / "dw"))
    schema = ("INSTANCIA string, HOST_NAME string, ANOMES int, TAMANHO_GB string, DELTA_1_MES string, DELTA_2_MESES string, "
              "DELTA_3_MESES string, DELTA_6_MESES string, DELTA_12_MESES string, DISPONIBILIDADE_PCT string, MINUTOS_INDISPONIVEIS string")
    one = lambda name, host: spark.createDataFrame([(name, host, 202401, *["1"] * 8)], schema)
    facts.load_fato_servidor(wh, one("A", None), mode="strict")
    before = stored(wh, "dim_servidor", "sk_servidor", "nk_servidor")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_whole", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt("killed")))
        with pytest.raises(KeyboardInterrupt):
            facts.load_fato_servidor(wh, one("A", "hosta"), mode="strict")
    assert stored(wh, "dim_servidor", "sk_servidor", "nk_servidor")[:1] == before
    facts.load_fato_servidor(wh, one("B", "hostb"), mode="strict")
    keys = [k for k, _ in stored(wh, "dim_servidor", "sk_servidor", "nk_servidor")]
    assert len(keys) == len(set(keys)) >= 2


def test_replaced_periods_keep_their_keys(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "dw"))
    schema = "sk_servidor bigint, sk_tempo_referencia int, minutos_indisponiveis int"
    load = lambda *rows: upserts.replace_period(
        wh, "fato_servidor", spark.createDataFrame(list(rows), schema), sk="sk_fato_servidor", grain=["sk_servidor", "sk_tempo_referencia"])
    cols = ("sk_servidor", "sk_tempo_referencia", "sk_fato_servidor", "minutos_indisponiveis")
    load((1, 20240101, 5), (2, 20240101, 6), (1, 20240201, 7))
    first = {r[:2]: r[2] for r in stored(wh, "fato_servidor", *cols)}
    load((2, 20240101, 8), (3, 20240101, 9))
    second = {r[:2]: r[2:] for r in stored(wh, "fato_servidor", *cols)}
    assert second[2, 20240101] == (first[2, 20240101], 8) and second[1, 20240201] == (first[1, 20240201], 7)
    assert set(second) == {(2, 20240101), (3, 20240101), (1, 20240201)} and second[3, 20240101][0] == 4
