"""Every registered query against its DuckDB statement."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from fixtures import registry
from tools.compare import compare, connect

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, sf_dir, name):
    n_rows, difference = compare(spark, duck, sf_dir, QUERIES[name], ORACLES.get(name))
    assert not difference
    assert n_rows > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 3


def test_oracles_need_no_extension(duck):
    assert isinstance(duck, duckdb.DuckDBPyConnection)
