"""Registered queries against DuckDB on the smallest driver tables.

By default the layer tables and a few of each group; ORACLE=all runs every query.
"""

import os

import pytest

import __spark_entry__ as contract
from checkbed.compare import connect, difference
from checkbed.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
PICKED = ("T", "S1_", "S4_", "S6_", "C1_", "P3_", "P7_", "D2_", "D6_", "D8_", "A9_", "E10_", "E25_", "U5_")
NAMES = [n for n in QUERIES if os.environ.get("ORACLE") == "all" or n.startswith(PICKED)]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    actual = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(contract.oracle_sql()[name]).fetchdf()
    assert difference(actual, expected) is None


def test_contract_is_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["competition", "pass_end_sector", "pass_direction", "passes", "completed", "by_winners"]
    assert not result.isEmpty()
