"""Every registered query against its DuckDB statement, over whole tables."""

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(name, spark, con, sf_dir):
    assert differences(spark, con, sf_dir, QUERIES[name], ORACLES[name]) is None
