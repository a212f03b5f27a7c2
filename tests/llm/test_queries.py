"""The registered queries against their DuckDB statements."""

import os

import pytest

import __spark_entry__
from tests.compare import differences, oracle_connection
from upcharts.llm.registry import ORACLE, QUERIES


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, name):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    assert differences(QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), ORACLE[name]) == []
