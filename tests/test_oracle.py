"""Every query with an SQL oracle must match DuckDB at sf0.01 (the driver's
correctness gate), and every registered query must run."""

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle_compare import compare, duck

from conftest import SF01

SQL_NAMES = sorted(oracle_sql())
ROWS_ONLY = sorted(set(queries()) - set(oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF01, con)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = queries()[name](spark, SF01)
    assert df.count() > 0
