"""Loads read only the months that may hold their keys, and no fact for its last key."""

import glob

import pytest

from deskstar import schemas
from deskstar.operators import upserts
from deskstar.sources.warehouse import BLOCK_BITS, Warehouse

TICKETS = "id_ticket_origem bigint, sk_tempo_criacao int, titulo_ticket string"
WIDE = 1 << BLOCK_BITS


def load(wh, *rows):
    upserts.upsert_by_id(wh, "fato_ticket", wh.spark.createDataFrame(list(rows), TICKETS), sk="sk_ticket")


def stored(wh):
    return sorted(map(tuple, wh.read("fato_ticket").select("id_ticket_origem", "titulo_ticket", "sk_ticket").collect()))


def spoil(wh, month):
    """Overwrite the files of a month, so that whoever reads them fails."""
    files = [f for f in wh.physical("fato_ticket").inputFiles() if f"mes_criacao={month}/" in f]
    assert files
    for file in files:
        path = file.removeprefix("file://").removeprefix("file:")
        with open(path, "wb") as out:
            out.write(b"spoiled")
        for checksum in glob.glob(path.rsplit("/", 1)[0] + "/.*.crc"):
            open(checksum, "wb").close()


@pytest.fixture
def loaded(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "dw"))
    load(wh, (1, 20240105, "a"), (2, 20240105, "b"), (WIDE * 3, 20240210, "c"), (-5, None, "d"))
    return wh


def months(wh, *ids):
    return wh.months_holding("fato_ticket", wh.spark.createDataFrame([(i,) for i in ids], "id bigint"))


def test_months_by_blocks(loaded):
    assert months(loaded, 2) == {202401} and months(loaded, WIDE * 3 + 1) == {202402} and months(loaded, -4096) == {None}
    assert months(loaded, 1, WIDE * 3) == {202401, 202402}
    assert months(loaded, WIDE * 9) == set() == months(loaded, None)
    load(loaded, (1, 20240301, "moved"), (2, 20240301, "moved"))
    assert months(loaded, 1) == {202403}  # the emptied month holds nothing, whatever its earlier summary says
    assert months(loaded, WIDE * 3) == {202402}
    upserts.remove_by_id(loaded, "fato_ticket", loaded.spark.createDataFrame([(WIDE * 3,)], "id_ticket_origem bigint"))
    assert months(loaded, WIDE * 3) == set()


def test_a_new_month_reads_no_other_month(loaded):
    spoil(loaded, 202401)
    with pytest.raises(Exception):
        loaded.read("fato_ticket").agg({"id_ticket_origem": "max"}).collect()
    load(loaded, (WIDE * 5, 20240301, "e"), (WIDE * 5 + 1, 20240301, "f"))
    load(loaded, (WIDE * 5 + 1, 20240301, "g"), (WIDE * 3, 20240402, "c2"))
    rest = loaded.physical("fato_ticket").where("mes_criacao > 202401").select("id_ticket_origem", "titulo_ticket", "sk_ticket")
    rows = {r[0]: r[1:] for r in rest.collect()}
    assert {i: t for i, (t, _) in rows.items()} == {WIDE * 5: "e", WIDE * 5 + 1: "g", WIDE * 3: "c2"}
    assert {rows[WIDE * 5][1], rows[WIDE * 5 + 1][1]} == {5, 6} and rows[WIDE * 3][1] <= 4


def test_false_hits_change_nothing(loaded):
    before = stored(loaded)
    load(loaded, (3, 20240301, "same block, other id"))
    assert stored(loaded) == sorted([*before, (3, "same block, other id", 5)])


def test_months_without_a_summary_are_read(spark, loaded, monkeypatch):
    with monkeypatch.context() as m:
        m.setitem(schemas.SUMMARISED, "fato_ticket", None)
        load(loaded, (7, 20240501, "no summary"))
    assert months(loaded, WIDE * 9) == {202405}
    load(loaded, (7, 20240601, "found"))
    assert [r[:2] for r in stored(loaded) if r[0] == 7] == [(7, "found")]
    assert len({r[2] for r in stored(loaded)}) == 5


def test_keys_of_other_writers_are_searched(loaded):
    own = loaded.spark.createDataFrame([(90, 20240105, "own", 70)], TICKETS + ", sk_ticket bigint")
    loaded.append(own, "fato_ticket")
    assert loaded.recorded("fato_ticket").last_key is None and loaded.last_key("fato_ticket", "sk_ticket") == 70
    load(loaded, (91, 20240105, "next"))
    assert loaded.recorded("fato_ticket").last_key == 71
    upserts.remove_by_id(loaded, "fato_ticket", loaded.spark.createDataFrame([(91,)], "id_ticket_origem bigint"))
    load(loaded, (92, 20240105, "after"))
    assert dict((r[0], r[2]) for r in stored(loaded))[92] == 72  # the key of a removed row is not given out again


def test_a_load_that_broke_off_between_record_and_switch_is_ended_by_the_next(loaded, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "_switch", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt("killed")))
        with pytest.raises(KeyboardInterrupt):
            load(loaded, (1, 20240301, "moved"), (8, 20240105, "new"))
    load(loaded, (8, 20240210, "again"))
    rows = stored(loaded)
    assert [r[:2] for r in rows] == [(-5, "d"), (1, "moved"), (2, "b"), (8, "again"), (WIDE * 3, "c")]
    assert len({k for *_, k in rows}) == 5
