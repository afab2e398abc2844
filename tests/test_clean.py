from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import NOON, document, documents, reading, rows_of
from sensormart.operators import (
    backfill_processed,
    clean_measurements,
    drop_repeats,
    flatten_measurements,
    latest_page,
    mark_processed,
    max_pressure,
    normalise_measurements,
    processed,
    split_unusable,
    unprocessed,
)
from sensormart.schemas import RAW_DOCUMENT


def test_flatten_keeps_spelling_in_the_key_and_drops_empty(spark):
    docs = documents(
        spark,
        [
            document("a", [reading("PM25"), reading("co")], city=None),
            document("b", []),
            document("c", None),
            document("d", [reading(None)]),
        ],
    )
    flat = flatten_measurements(docs)
    assert rows_of(flat, "measurement_id", "parameter_name", "city") == [
        (None, None, "c"),
        ("a_PM25", "pm25", None),
        ("a_co", "co", None),
    ]


def test_flags(spark):
    docs = documents(spark, [document(str(f), [reading()], processed=f) for f in (True, False, None)])
    assert rows_of(unprocessed(docs), "_id.oid") == [("False",)]
    assert rows_of(processed(docs), "_id.oid") == [("True",)]
    assert rows_of(unprocessed(backfill_processed(docs)), "_id.oid") == [("False",), ("None",)]
    marked = mark_processed(docs, unprocessed(docs))
    assert rows_of(marked, "_id.oid", "processed") == [("False", True), ("None", None), ("True", True)]


def test_clean_chain_and_observation(spark):
    docs = documents(
        spark,
        [document("a", [reading("Pressure", 1013.0, "hPa"), reading("pressure", 1000.0, "hpa"), reading("co", 2.0, "ppm")])],
    )
    watch = Observation()
    got = rows_of(clean_measurements(docs, watch=watch), "measurement_id", "parameter_name", "value", "unit")
    assert got == [
        ("a_Pressure", "pressure", 87000.0, "hPa"),
        ("a_co", "co", 2 * 1145.94, "µg/m³"),
        ("a_pressure", "pressure", 100000.0, "Pa"),
    ]
    assert watch.get == {"readings": 3, "max_pressure": 1013.0}
    assert max_pressure(flatten_measurements(docs)).first().max_value == 1013.0


def test_unusable_readings_are_put_aside(spark):
    docs = documents(spark, [document("a", [reading("co", at="garbage"), reading(None), reading("no2")])])
    good, bad = split_unusable(clean_measurements(docs))
    assert rows_of(good, "measurement_id") == [("a_no2",)]
    assert rows_of(bad, "measurement_id", "reject_reason") == [(None, "no key"), ("a_co", "malformed time")]


def test_pages_are_cut_in_order(spark):
    docs = documents(spark, [document(f"d{i:03}", [reading(at=f"2024-01-01T00:{i // 4:02}:00Z")]) for i in range(150)])
    pages = [[r[0] for r in latest_page(docs, page).select("_id.oid").collect()] for page in (1, 2, 3)]
    expected = sorted(range(150), key=lambda i: (-(i // 4), i))
    assert pages == [[f"d{i:03}" for i in expected[:100]], [f"d{i:03}" for i in expected[100:]], []]
    plan = latest_page(docs, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_normalise_and_repeats(spark):
    docs = documents(
        spark,
        [
            document("b", [reading("no2"), reading("co")]),
            document("a", [reading("co"), reading("no2")]),
            document("c", [reading("co")]),
            document("d", [reading("co"), reading("no2")], city=None),
        ],
    )
    first = normalise_measurements(docs).filter("_id.oid = 'b'").first()
    assert [m.parameter for m in first.measurements] == ["co", "no2"]
    kept = drop_repeats(docs)
    assert kept.columns == [f.name for f in RAW_DOCUMENT.fields]
    assert rows_of(kept, "_id.oid") == [("a",), ("c",), ("d",)]


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "docs")
    documents(spark, [document("a", [reading()])]).write.parquet(path)
    stored = spark.read.schema(RAW_DOCUMENT).parquet(path)
    clean = clean_measurements(stored)
    plan = clean.select("parameter_name").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<measurements:array<struct<parameter:string>>>" in plan
    plan = clean.select("latitude").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "lastUpdated" not in plan.split("ReadSchema")[1]


def test_noon_is_shared(spark):
    docs = documents(spark, [document("a", [reading()])])
    assert clean_measurements(docs).select(F.col("observed_utc").cast("string")).first()[0] == NOON[:19].replace("T", " ")
