"""The registered queries against their SQL forms, and what they promise."""

import duckdb
import pytest

from sensormart.llm.queries import ORACLE_SQL, QUERIES

TABLES = ["documents", "embeddings", "pages", "labels", "benchmark"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    expected = duck.sql(ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = [sorted(map(tuple, f[columns].astype(object).where(f[columns].notna(), None).values), key=str) for f in (got, expected)]
    assert rows[0] == rows[1]
