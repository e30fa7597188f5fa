"""Joins, keys, upserts and checks on small frames, against brute force where it matters."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deskstar.operators import capacity, dedupe, joins, keys, members, quality, upserts
from deskstar.sources.warehouse import Warehouse

C = F.col


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_both_lookup_paths_agree(spark):
    fact = spark.range(2000).select("id", F.when(C("id") % 3 == 0, "").when(C("id") % 3 == 1, "hot").otherwise(C("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("5", 2), ("5", 3), (None, 9)], "nk string, sk int")
    small = joins.left_lookup(fact, dim, [("k", "nk")], ["id"])
    salted = joins.left_lookup(fact, dim, [("k", "nk")], ["id"], limit=0)
    assert rows(small) == rows(salted) and small.count() == 2001
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan and "_s" in plan


def test_only_hot_keys_are_repeated(spark):
    """A key with 90 % of the rows, blank keys and two key columns: the rows of the plain join, few copies."""
    key = F.when(C("id") % 10 < 9, F.lit(-1)).when(C("id") % 20 == 9, F.lit(None)).otherwise(C("id"))
    fact = spark.range(6000).select("id", key.cast("bigint").alias("k"), F.lit("x").alias("m"))
    dim = spark.range(-1, 6000).select(C("id").alias("nk"), F.lit("x").alias("nm"), (C("id") * 2).alias("sk"))
    on = [("k", "nk"), ("m", "nm")]
    hot = joins.hot_keys(fact, ["k", "m"], 16)
    one = fact.where("k = -1").select(F.xxhash64("k", "m").alias("h")).first()["h"]
    assert set(hot) == {one} and hot[one] == 16
    spread = joins.left_lookup(fact, dim, on, ["id"], tasks=16, limit=0)
    assert rows(spread) == rows(joins.left_lookup(fact, dim, on, ["id"])) and spread.columns == ["id", "k", "m", "sk"]
    even = joins.left_lookup(fact.where("k >= 0"), dim, on, ["id"], tasks=16, limit=0)
    assert even.count() == 300 and "explode" not in even._jdf.queryExecution().optimizedPlan().toString().lower()
    narrow = fact.withColumn("k", C("k").cast("int"))
    assert rows(joins.left_lookup(narrow, dim, on, ["id"], limit=0)) == rows(joins.left_lookup(narrow, dim, on, ["id"]))
    none = joins.left_lookup(fact.where("id < 0"), dim, on, ["id"], limit=0)
    assert none.count() == 0 and joins.hot_keys(fact.where("k is null"), ["k"], 16) == {}


def test_outer_merge(spark):
    a = spark.createDataFrame([("x", 1, 10), ("y", None, 20)], "k string, m int, a int")
    b = spark.createDataFrame([("y", None, 5), ("z", 1, 6)], "k string, m int, b int")
    assert rows(joins.merge_outer_one_to_one(a, b, ["k", "m"])) == rows(spark.createDataFrame(
        [("x", 1, 10, None), ("y", None, 20, 5), ("z", 1, None, 6)], "k string, m int, a int, b int"))
    for left, right in ((a.union(a), b), (a, b.union(b))):
        with pytest.raises(Exception, match="repeats key"):
            joins.merge_outer_one_to_one(left, right, ["k", "m"]).collect()


def test_surrogate_keys_are_dense_and_stable(spark):
    new = spark.range(1000).select((C("id") * 7).alias("nk"))
    first = keys.assign_surrogate_keys(new.repartition(5), "nk", "sk", F.lit(100), buckets=13)
    again = keys.assign_surrogate_keys(new.repartition(3, "nk"), "nk", "sk", F.lit(100), buckets=13)
    assert rows(first.select("nk", "sk")) == rows(again.select("nk", "sk"))
    assert sorted(r.sk for r in first.collect()) == list(range(101, 1101))


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), (7, 1, "c")], "k int, o int, v string")
    first = dedupe.keep_first(df, ["k"], [C("o")])
    assert rows(first.select("k", "v")) == rows(spark.createDataFrame([(None, "a"), (7, "c")], "k int, v string"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_deltas_skip_gaps(spark):
    sizes = spark.createDataFrame([("s", 202312, 10), ("s", 202401, 15), ("s", 202403, 18)], "instancia string, anomes int, tamanho_gb int")
    got = {r.anomes: (r.delta_1_mes, r.delta_2_meses, r.delta_3_meses) for r in capacity.capacity_deltas(sizes).collect()}
    assert got == {202312: (None, None, None), 202401: (5, None, None), 202403: (None, 3, 8)}


def test_upsert_moves_rows_and_empties_a_month(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    schema = "id_ticket_origem bigint, sk_tempo_criacao int, titulo_ticket string"
    upserts.upsert_by_id(wh, "fato_ticket", spark.createDataFrame([(1, 20240105, "a"), (2, 20240210, "b"), (3, 20240211, "c")], schema), sk="sk_ticket")
    batch = spark.createDataFrame([(1, 20240301, "novo"), (2, 20240210, "b2"), (4, 20240301, "d")], schema)
    for _ in range(2):
        upserts.upsert_by_id(wh, "fato_ticket", batch, sk="sk_ticket")
    table = wh.read("fato_ticket")
    assert rows(table.select("id_ticket_origem", "titulo_ticket")) == [(1, "novo"), (2, "b2"), (3, "c"), (4, "d")]
    assert table.select("sk_ticket").distinct().count() == 4


def test_replace_period_drops_absent_servers(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    schema = "instancia string, anomes int, minutos_indisponiveis int"
    upserts.replace_period(wh, "fato_servidores_mensal", spark.createDataFrame([("a", 202401, 1), ("b", 202401, 2), ("a", 202402, 3)], schema))
    upserts.replace_period(wh, "fato_servidores_mensal", spark.createDataFrame([("b", 202401, 9)], schema))
    assert rows(wh.read("fato_servidores_mensal").select("instancia", "anomes", "minutos_indisponiveis")) == [("a", 202402, 3), ("b", 202401, 9)]


def test_replace_month_appends_rows_of_other_months(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    day = lambda m, d: dt.date(2024, m, d)
    schema = "id_ticket bigint, data_criacao date"
    upserts.replace_month_by_date(wh, "fato_tickets", spark.createDataFrame([(1, day(1, 2)), (2, day(2, 2)), (3, None)], schema), 202401)
    upserts.replace_month_by_date(wh, "fato_tickets", spark.createDataFrame([(4, day(2, 3))], schema), 202401)
    assert sorted(r.id_ticket for r in wh.read("fato_tickets").collect()) == [2, 3, 4]


def test_enrich_fills_blanks_only(spark):
    dim = spark.createDataFrame([("a", "", None), ("b", "tem", ""), ("c", None, "x")], "k string, i string, h string")
    upd = spark.createDataFrame([("a", "i1", "h1"), ("b", "i2", None)], "k string, i string, h string")
    assert rows(members.coalesce_enrich(dim, upd, "k", ["i", "h"])) == [("a", "i1", "h1"), ("b", "tem", None), ("c", None, "x")]


def test_strict_checks_fail_the_job(spark):
    fact = spark.createDataFrame([(1, 5, "a"), (2, None, "b")], "id int, sk int, nome string")
    good, bad = quality.require_resolved_sk(fact, {"sk": "nome"}, "quarantine")
    assert [r.id for r in good.collect()] == [1] and [(r.id, r.chave_ausente) for r in bad.collect()] == [(2, "sk")]
    with pytest.raises(Exception, match='unresolved sk from .*"b"'):
        quality.require_resolved_sk(fact, {"sk": "nome"})[0].collect()
    months = spark.createDataFrame([(202613, None)], "m int, d date")
    with pytest.raises(Exception, match="invalid value in m: 202613"):
        quality.reject_invalid_period(months, "d", "m").collect()
    with pytest.raises(quality.QualityError):
        quality.require_unique_key(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y"), (None, None)], "k int, `a.b` string")
    assert rows(quality.null_profile(df)) == [("a.b", 4, Decimal("50.00")), ("k", 4, Decimal("50.00"))]
    assert quality.duplicate_count(df, "k").first()[0] == 2
    assert {r.coluna: r.situacao for r in quality.dw_conformity(df, ["k", "z"]).collect()} == {"k": "OK", "z": "FALTANDO"}
    report = quality.audit_report(df, df, "k", "k", {"a.b": ["x"]}, ["k"])
    assert [(r.valor, r.linhas) for r in report["dominio_a.b"].collect()] == [("y", 1)]
    assert report["diferenca"].isEmpty()


def test_upsert_keeps_the_rows_without_a_month(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    schema = "id_ticket_origem bigint, sk_tempo_criacao int, titulo_ticket string"
    load = lambda *batch: upserts.upsert_by_id(
        wh, "fato_ticket", spark.createDataFrame(list(batch), schema), sk="sk_ticket")
    load((10, None, "a"), (11, None, "b"), (1, 20240105, "c"))
    load((12, None, "d"))
    load((11, 20240105, "e"))
    assert rows(wh.read("fato_ticket").select("id_ticket_origem", "titulo_ticket")) == [
        (1, "c"), (10, "a"), (11, "e"), (12, "d")]


def test_rejected_rows_are_kept_once(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    assert wh.rejected("fato_csi").count() == 0
    bad = spark.createDataFrame([(1, None, "x"), (2, None, "y")], "id_ticket bigint, sk int, titulo string")
    for _ in range(2):
        wh.reject(bad, "fato_csi", ["id_ticket"], F.lit("csi_status"))
    assert rows(wh.rejected("fato_csi").select("chave", "motivo")) == [("1", "csi_status"), ("2", "csi_status")]
