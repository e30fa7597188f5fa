"""Every registered query against its SQL twin."""

import pytest

from deskstar.catalogue import QUERIES, TWINS
from compare import compare, connect




@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, con, sf_dir, name):
    problems = compare(spark, con, name, QUERIES[name], TWINS[name], sf_dir)
    assert not problems
