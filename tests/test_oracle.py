"""Every registered query against its SQL twin on the given tables."""

import duckdb
import pytest
from conftest import MEDIUM

import __spark_entry__ as entry_module
from gatewatch.plans.catalog import catalog

SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{MEDIUM}/events.parquet'")
    return connection


@pytest.fixture(scope="module")
def twins():
    return entry_module.queries(), entry_module.oracle_sql()


NAMES = sorted(catalog())


def test_every_query_has_a_twin(twins):
    queries, oracle = twins
    assert set(NAMES) <= set(queries)
    assert set(NAMES) <= set(oracle)


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, sql, twins, name):
    queries, oracle = twins
    df = queries[name](spark, MEDIUM)
    result = sql.execute(oracle[name])
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    names = sorted(columns)
    expected = sorted(tuple(repr(row[columns.index(n)]) for n in names)
                      for row in result.fetchall())
    got = sorted(tuple(repr(row[n]) for n in names) for row in df.collect())
    assert len(got) > 0
    assert got == expected


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["city", "device_type", "login_method", "total_attempts",
                          "successful_attempts", "failed_attempts", "success_rate"]
    assert df.count() > 0
