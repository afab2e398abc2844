"""Every registered query against its SQL form in DuckDB."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract

TABLES = ["region", "nation", "events"]


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _ordered(frame):
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if "datetime" in str(frame[column].dtype):
            frame[column] = frame[column].astype("datetime64[us]")
        elif frame[column].dtype == object:
            frame[column] = frame[column].astype(str)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_an_oracle():
    assert set(contract.star_queries()) == set(contract.oracles.all_queries())


@pytest.mark.parametrize("name", sorted(contract.star_queries()))
def test_query(spark, sf_dir, duck, name):
    result = contract.star_queries()[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("NestedLoop", "Cartesian", "Python"))
    got = _ordered(result.toPandas())
    expected = _ordered(duck.sql(contract.oracle_sql()[name]).df())
    assert list(got.columns) == list(expected.columns)
    assert list(got.dtypes) == list(expected.dtypes)
    for column in got.columns:
        np.testing.assert_array_equal(got[column].to_numpy(), expected[column].to_numpy(), column)


def test_flagship(spark):
    assert not contract.entry(spark).isEmpty()
