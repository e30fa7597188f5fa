"""Dictionaries that are tables."""

import pytest
from pyspark.sql import functions as F

from deskstar.operators.joins import table_lookup


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_lookup_in_a_table(spark, limit):
    """Both plans; one code holds most rows, others are null, unknown, not a number, or stand for nothing."""
    asked = ["1"] * 200 + ["2", "3", "x", None, "9", "4"]
    rows = spark.createDataFrame(list(enumerate(asked)), "id int, codigo string").repartition(4)
    entries = spark.createDataFrame([(1, "um"), (1, "um"), (2, "dois"), (3, None), (None, "nada"), (4, "")], "k bigint, v string")
    found = table_lookup(rows, F.col("codigo"), entries, "nome", ["id"], "?", limit=limit, tasks=4)
    assert found.columns == ["id", "codigo", "nome"]
    names = {"1": "um", "2": "dois", "4": ""}
    assert sorted((r.id, r.nome) for r in found.collect()) == [(i, names.get(c, "?")) for i, c in enumerate(asked)]


def test_ambiguous_entries_fail(spark):
    rows = spark.createDataFrame([(1, 1)], "id int, codigo bigint")
    entries = spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, v string")
    with pytest.raises(Exception, match="nome: two values for 1"):
        table_lookup(rows, F.col("codigo"), entries, "nome", ["id"]).collect()
