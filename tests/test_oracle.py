"""Every SQL-expressible registered query equals its DuckDB oracle on sf0.01."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_harness import compare, duck

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], con, SF01)
    assert "error" not in r, r
    assert "types" not in r, r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["estacao", "hora_pico_calor", "hora_mais_seca"]
