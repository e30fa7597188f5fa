"""A filter on the month of a mart prunes the partitions of the facts."""

import re

import pytest

from deskstar import bindings as b
from deskstar.plans import marts

FACTS = {
    "star_detail_left": ["fato_ticket"], "star_detail_csi": ["fato_csi"], "star_detail_inner": ["fato_servidor"],
    "ticket_indicators": ["fato_ticket"], "calendar_two_fact_join": ["fato_ticket", "fato_servidor"],
    "executive_summary": ["fato_ticket", "fato_servidor"], "executive_summary_fixed": ["fato_ticket", "fato_servidor"],
    "bridge_join": ["fato_ticket"], "bridge_join_fixed": ["fato_ticket", "fato_servidor"],
}


@pytest.mark.parametrize("name", sorted(FACTS))
def test_month_reaches_the_facts(spark, sf_dir, name):
    mart = getattr(marts, name)(b.star(spark, sf_dir).warehouse)
    month = mart.where("anomes = 202401")
    plan = month._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for fact in FACTS[name]:
        scans = [part for part in plan.split("\n\n") if re.match(rf"\s*\(\d+\) Scan parquet \S*\.{fact}\b", part)]
        pruned = [part for part in scans if re.search(r"PartitionFilters: \[[^\]]*202401|dynamicpruning|PartitionFilters: \[[^\]]*IN ", part)]
        assert scans and len(scans) == len(pruned), "\n\n".join(scans)
    expected = sorted(repr(tuple(r)) for r in mart.collect() if r["anomes"] == 202401)
    assert sorted(repr(tuple(r)) for r in month.collect()) == expected and expected
