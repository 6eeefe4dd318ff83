"""The queries of this subpackage that have SQL, against DuckDB; the contract of all of them."""

import os

import pytest

import __spark_entry__ as contract
from checkbed.compare import connect, difference
from matchlake.llm.oracle import ORACLES
from matchlake.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(session, name):
    actual = QUERIES[name](session, SF_DIR).toPandas()
    expected = connect(SF_DIR).execute(ORACLES[name]).fetchdf()
    assert difference(actual, expected) is None


def test_all_are_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert all(any(q.startswith(n) for q in contract.queries()) for n in names)
    assert "pipeline" in contract.queries()
    assert set(ORACLES) <= set(contract.oracle_sql())
