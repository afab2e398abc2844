from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import document, documents, reading, rows_of
from sensormart.operators import (
    clean_measurements,
    location_dim,
    new_dimension_rows,
    next_id,
    number_rows,
    parameter_dim,
    resolve_ids,
    time_dim,
)
from sensormart.schemas import LOCATION_TABLE, PARAMETER_TABLE, empty_table


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ids_are_contiguous_in_key_order(spark, partitions):
    """Whatever the input partitioning is, and with more range partitions than rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 5000, 7).select((F.col("id") * 37 % 5003).alias("k")).repartition(partitions)
        got = number_rows(rows, ["k"], "id", first=11).orderBy("k").collect()
        few = number_rows(spark.range(3), ["id"], "n").orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r.id for r in got] == list(range(11, 11 + len(got)))
    assert [r.n for r in few] == [1, 2, 3]


def test_no_rows(spark):
    assert number_rows(spark.range(0), ["id"], "n").count() == 0


def test_next_id(spark):
    assert spark.range(1).select(next_id(empty_table(spark, PARAMETER_TABLE), "parameter_id")).first()[0] == 1
    table = spark.createDataFrame([(7, "co"), (3, "no2")], "parameter_id bigint, parameter_name string")
    assert spark.range(1).select(next_id(table, "parameter_id")).first()[0] == 8


def test_extraction(spark):
    docs = documents(
        spark,
        [
            document("a", [reading("relativehumidity"), reading("co")], location="z"),
            document("b", [reading("co", at="2024-10-27T00:30:00Z")], location="y", city=None),
            document("c", [reading("CO", at="2024-10-27T01:30:00Z")], at=None),
            document("d", [reading(None, at="garbage")], at=(1.0, None)),
        ],
    )
    clean = clean_measurements(docs)
    assert rows_of(location_dim(clean), "location_name", "city", "latitude", "longitude") == [("y", None, 1.0, 2.0)]
    assert rows_of(parameter_dim(clean), "parameter_name") == [("co",), ("humidity",)]
    assert rows_of(time_dim(clean), "timestamp", "year", "month", "day", "hour", "minute", "second") == [
        (datetime(2024, 7, 1, 14), 2024, 7, 1, 14, 0, 0),
        (datetime(2024, 10, 27, 2, 30), 2024, 10, 27, 2, 30, 0),
    ]


def test_resolution_keeps_stored_ids_and_is_stable(spark):
    existing = spark.createDataFrame(
        [(5, 1.0, 1.0), (9, 3.0, 3.0), (2, 8.0, 8.0)], "location_id bigint, latitude double, longitude double"
    )
    keys = ["latitude", "longitude"]
    new = spark.createDataFrame([(4.0, 4.0), (3.0, 3.0), (0.0, 9.0), (-0.0, 2.0)], "latitude double, longitude double")
    resolved = resolve_ids(new, existing, keys, "location_id", new_flag="is_new")
    assert rows_of(resolved, "latitude", "longitude", "location_id", "is_new") == [
        (0.0, 2.0, 10, True),
        (0.0, 9.0, 11, True),
        (3.0, 3.0, 9, False),
        (4.0, 4.0, 12, True),
    ]
    assert rows_of(new_dimension_rows(resolved, existing, keys), "location_id") == [(10,), (11,), (12,)]
    grown = existing.unionByName(resolved.filter("is_new").select(*existing.columns))
    again = resolve_ids(new, grown, keys, "location_id")
    assert rows_of(again, "latitude", "longitude", "location_id") == rows_of(resolved, "latitude", "longitude", "location_id")
    assert new_dimension_rows(again, grown, keys).isEmpty()


def test_resolution_against_an_empty_table(spark):
    new = spark.createDataFrame([("n", "c", "k", 2.0, 2.0), ("m", "c", "k", 1.0, 1.0)], "location_name string, city string, country string, latitude double, longitude double")
    resolved = resolve_ids(new, empty_table(spark, LOCATION_TABLE), ["latitude", "longitude"], "location_id")
    assert rows_of(resolved, "location_id", "location_name") == [(1, "m"), (2, "n")]
