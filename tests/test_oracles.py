"""Layer 1: every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = entry._ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from cropwire.plans.queries import KEYS
    assert set(KEYS) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    problems, _, _ = compare(spark, con, key, entry.queries()[key], ORACLES[key], SF)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "price_timestamp", "open", "high", "low", "close", "volume"]
