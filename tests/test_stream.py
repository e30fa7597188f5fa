import json
import os

from deskstar.operators.upserts import upsert_by_id
from deskstar.sources.warehouse import Warehouse
from deskstar.streaming.tickets import stream_tickets


def test_first_copy_wins_across_micro_batches(spark, tmp_path):
    def land(name, time, page, *tickets):
        rows = [{"id": i, "company_id": 1, "subject": s, "status": status, "type": "Incidente", "created_at": "2026-01-05T10:00:00Z",
                 "updated_at": "2026-01-05T12:00:00Z", "window_start": "2026-01-01", "page": page, "pos": p,
                 "custom_fields": {"cf_csi_status": csi}} for p, (i, s, status, csi) in enumerate(tickets)]
        path = tmp_path / "landing" / name
        path.write_text(json.dumps(rows))
        os.utime(path, (time, time))

    (tmp_path / "landing").mkdir()
    # The later page lands first for 1 and 3, last for 2; only the later copy of 3 is an improvement.
    land("a.json", 1_000_000, 2, (1, "late", 5, None), (3, "CSI late", 5, "Aberto"))
    land("b.json", 2_000_000, 1, (1, "early", 2, None), (2, "early", 2, None), (3, "early", 2, None))
    land("c.json", 3_000_000, 3, (2, "late", 5, None))
    found = []
    for files in (1, 1000):
        wh = Warehouse(spark, str(tmp_path / f"dw{files}"))
        stream_tickets(wh, str(tmp_path / "landing"), str(tmp_path / f"c{files}"), files_per_batch=files).awaitTermination()
        names = {r[0]: r[1] for r in wh.read_dimension("dim_status_ticket").collect()}
        fact = {r.id_ticket_origem: (r.titulo_ticket, names[r.sk_status_ticket]) for r in wh.read("fato_ticket").collect()}
        found.append((fact, wh.read("fato_csi").count()))
    assert set(found[0][0]) == {1, 2, 3}
    assert found[0] == found[1]
    assert found[0][1] == 0 and len(set(found[0][0].values())) == 1


def _small_warehouse(spark, tmp_path, *lines):
    (tmp_path / "landing").mkdir()
    for i, line in enumerate(lines):
        (tmp_path / "landing" / f"{i}.json").write_text(line)
    wh = Warehouse(spark, str(tmp_path / "dw"))
    stream_tickets(wh, str(tmp_path / "landing"), str(tmp_path / "c"), files_per_batch=1).awaitTermination()
    return wh


def test_a_batch_is_dealt_out_once(spark, tmp_path, monkeypatch):
    """Tickets that were not loaded before are not dealt out again by their id."""
    staged, stage = {}, Warehouse.stage

    def noted(self, df, label):
        staged.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return stage(self, df, label)

    monkeypatch.setattr(Warehouse, "stage", noted)
    ticket = {"id": 1, "company_id": 1, "subject": "a", "status": 2, "type": "Incidente", "created_at": "2026-01-05T10:00:00Z",
              "updated_at": "2026-01-05T12:00:00Z", "window_start": "2026-01-01", "page": 1, "pos": 0}
    wh = _small_warehouse(spark, tmp_path, json.dumps([ticket, {**ticket, "page": 2}]))
    assert wh.read("fato_ticket").count() == 1
    assert "stream-placed" not in staged
    assert "Window" in staged["stream-seen"] and "Window" not in staged["stream-curated"]


def test_stored_months_are_not_dealt_by_key(spark, tmp_path, monkeypatch):
    """A second batch writes the month anew: few of its keys are stored, so these are broadcast to the stored rows."""
    plans, overwrite = [], Warehouse.overwrite_partitions

    def noted(self, df, table, *args, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return overwrite(self, df, table, *args, **options)

    monkeypatch.setattr(Warehouse, "overwrite_partitions", noted)
    wh = Warehouse(spark, str(tmp_path / "dw"))
    for ids in ("1, 2, NULL", "2, 3"):
        batch = spark.sql(f"SELECT explode(array({ids})) AS id_ticket_origem, 20260105 AS sk_tempo_criacao")
        upsert_by_id(wh, "fato_ticket", batch.withColumn("id_ticket_origem", batch[0].cast("long")), sk="sk_ticket")
    rows = [(r["id_ticket_origem"], r["sk_ticket"]) for r in wh.read("fato_ticket").collect()]
    assert sorted(r[0] for r in rows if r[0]) == [1, 2, 3] and len({r[1] for r in rows}) == len(rows)
    anti = [line for line in plans[-1].splitlines() if "LeftAnti" in line]
    assert anti and all("broadcast" in line for line in anti[:1])
