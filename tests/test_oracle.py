"""Every registered query against its DuckDB statement on the test tables."""

import os

import pytest

from tests.compare import differences, oracle_connection
from upcharts.oracle import ORACLE
from upcharts.registry import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_dir, oracle, name):
    assert differences(QUERIES[name](spark, sf_dir), oracle, ORACLE[name]) == []
