"""Every registered query against its DuckDB oracle on the smallest tables.

The driver runs the same comparison at sf0.01 (``python tests/compare.py``)."""

import pytest

from tests.compare import compare
from tests.conftest import SF_SMALL

import __spark_entry__ as contract
from tillbook.queries import registered

QUERIES = registered()
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    result = compare(spark, duck_small, SF_SMALL, name, QUERIES[name], ORACLE[name])
    assert result["status"] == "ok", result


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "revenue_usd" in df.columns
