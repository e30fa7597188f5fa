from pyspark.sql import functions as F

from deskstar.catalogue import QUERIES


def test_every_line_and_customer_counts(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.sum("l_quantity").cast("decimal(14,2)")).first()[0]
    found = QUERIES["capacity_deltas_all_lines"](spark, sf_dir)
    assert found.agg(F.sum("tamanho_gb").cast("decimal(14,2)")).first()[0] == lines
    mart = QUERIES["ordered_mart_all_customers"](spark, sf_dir).collect()
    assert sum(r.clientes for r in mart) == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    empty = [r.c_mktsegment is None for r in mart]
    assert any(empty) and empty == sorted(empty)
