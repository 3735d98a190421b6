"""The operators that SQL can express, against DuckDB on sf0.001."""

import pytest

from cropwire.llm.queries import ORACLES, QUERIES
from tools.oracle_check import compare, duck

from .conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    problems, rows, _ = compare(spark, con, key, QUERIES[key], ORACLES[key], SF)
    assert not problems and rows > 0


def test_ten_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))


def test_every_oracle_is_sql():
    import __spark_entry__ as entry
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())
