import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import document, documents, reading, rows_of
from sensormart.operators import (
    build_facts,
    clean_measurements,
    first_per_reading,
    integrity_violations,
    latest_readings,
    mark_latest,
    settled_readings,
    upsert_facts,
)
from sensormart.plans import fresh_star, hourly_sums, trend_by_hour, trend_of_sums
from sensormart.schemas import FACT, FACT_TABLE, LOCATION_TABLE, PARAMETER, PARAMETER_TABLE, TIME, TIME_TABLE

T = datetime(2024, 7, 1, 14)
LATER = "2024-07-01T13:00:00Z"


def _dims(spark):
    location = spark.createDataFrame([(1, 1.0, 2.0)], "location_id bigint, latitude double, longitude double")
    parameter = spark.createDataFrame([(4, "co")], "parameter_id bigint, parameter_name string")
    time = spark.createDataFrame([(6, T)], "time_id bigint, timestamp timestamp_ntz")
    return location, parameter, time


def test_unknown_keys_give_null_ids(spark):
    docs = documents(spark, [document("a", [reading("co"), reading("no2")]), document("b", [reading("co", at=LATER)], at=None)])
    facts = build_facts(clean_measurements(docs), *_dims(spark))
    assert rows_of(facts, "measurement_id", "location_id", "parameter_id", "time_id") == [
        ("a_co", 1, 4, 6),
        ("a_no2", 1, None, 6),
        ("b_co", None, 4, None),
    ]


def test_latest_reading_wins(spark):
    docs = documents(
        spark,
        [
            document("a", [reading("co", 9.0), reading("co", 1.0, at=LATER), reading("co", 2.0, at=LATER), reading("CO", 5.0)]),
            document("b", [reading("co", 3.0, at="garbage"), reading("co", 4.0)]),
        ],
    )
    assert rows_of(latest_readings(clean_measurements(docs)), "measurement_id", "value") == [("a_CO", 5.0), ("a_co", 2.0), ("b_co", 4.0)]


def _random_documents(rng, n):
    """Parameters twice under one spelling, other spellings, equal instants in other zones, odd values."""
    times = [LATER, "2024-07-01T15:00:00+02:00", "2024-07-01T12:00:00Z", "garbage", None, "2024-07-01T12:00:00.500Z"]
    values = [None, float("nan"), float("inf"), 1.0, 2.0, 850.0, 900.0, 1013.0, 101300.0, -5.0]
    names, units = ["co", "CO", "pressure", "Pressure", "pm25", None], ["ppm", "ppb", "hpa", "mb", "pa", "x", None]
    pick = lambda options: options[rng.randrange(len(options))]
    rows = [
        document(f"d{i}", [(pick(names), pick(values), pick(units), pick(times)) for _ in range(rng.randrange(12))])
        for i in range(n)
    ]
    return [*rows, document("null", None), document("holes", [None, reading("co"), None, reading("co", 2.0)])]


def test_settled_inside_documents_as_by_key(spark):
    docs = documents(spark, _random_documents(random.Random(7), 150))
    columns = ["measurement_id", "parameter_name", "value", "unit", "timestamp", "observed_utc"]
    for strict in (False, True):
        clean = clean_measurements(docs, strict=strict).filter("measurement_id IS NOT NULL")
        settled = settled_readings(docs, strict).filter("measurement_id IS NOT NULL")
        wanted = latest_readings(clean)
        got = settled.filter("latest").select(*wanted.columns)
        texts = [sorted(map(str, t.select(*columns).collect())) for t in (got, wanted, settled, clean)]
        assert texts[0] == texts[1] and texts[2] == texts[3]


def test_settling_needs_no_shuffle_and_sorts_once(spark):
    docs = documents(spark, _random_documents(random.Random(8), 5))
    plan = settled_readings(docs).filter("latest")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and plan.count("array_sort(") == 1
    assert mark_latest(docs).schema["measurements"].dataType.elementType.names[-1] == "latest"


def test_first_per_reading(spark):
    docs = documents(spark, [document("a", [reading("co", 9.0), reading("co", 1.0), reading("co", 5.0, at=LATER)])])
    assert rows_of(first_per_reading(clean_measurements(docs)), "measurement_id", "value") == [("a_co", 1.0), ("a_co", 5.0)]


def test_upsert_always_takes_the_incoming_row(spark):
    target = spark.createDataFrame([("a", 1, 1, 9, 1.0, "x"), ("b", 1, 1, 9, 2.0, "x")], FACT)
    source = spark.createDataFrame([("b", 2, 2, 1, 3.0, "y"), ("c", 1, 1, 1, 4.0, "x")], FACT)
    merged = upsert_facts(target, source)
    expected = [("a", 1, 1, 9, 1.0, "x"), ("b", 2, 2, 1, 3.0, "y"), ("c", 1, 1, 1, 4.0, "x")]
    assert rows_of(merged, *FACT.names) == expected
    assert rows_of(upsert_facts(merged, source), *FACT.names) == expected


def _star(spark):
    docs = documents(
        spark,
        [
            document("a", [reading("co", 1.0), reading("no2", 2.0)]),
            document("b", [reading("co", 4.0), reading("no2", 2.0, at=LATER)], at=(3.0, 3.0)),
        ],
    )
    return fresh_star(docs)


def test_integrity(spark):
    star = _star(spark)
    assert integrity_violations(star).filter("violations > 0").isEmpty()
    broken = dict(star)
    broken[TIME_TABLE] = star[TIME_TABLE].filter("hour <> 15")
    broken[LOCATION_TABLE] = star[LOCATION_TABLE].unionByName(star[LOCATION_TABLE])
    broken[FACT_TABLE] = star[FACT_TABLE].withColumn("parameter_id", F.lit(None).cast("bigint"))
    found = rows_of(integrity_violations(broken).filter("violations > 0"), "table_name", "rule", "violations")
    assert found == [
        (FACT_TABLE, "time_id resolves", 1),
        (LOCATION_TABLE, "natural key unique", 2),
        (LOCATION_TABLE, "primary key unique", 2),
    ]


def test_trend(spark):
    got = rows_of(trend_by_hour(_star(spark)), "parameter_name", "hour", "readings", "avg_value", "min_value", "max_value")
    assert got == [("co", 14, 2, 2.5, 1.0, 4.0), ("no2", 14, 1, 2.0, 2.0, 2.0), ("no2", 15, 1, 2.0, 2.0, 2.0)]


def test_trend_without_numbers(spark):
    docs = documents(spark, [document("a", [reading("co", None)]), document("b", [reading("no2", float("nan")), reading("NO2", 4.0)])])
    trend = trend_by_hour(fresh_star(docs))
    assert rows_of(trend, "parameter_name", "readings", "avg_value", "min_value") == [("co", 1, None, None), ("no2", 2, 4.0, 4.0)]


def test_trend_of_very_large_and_small_values(spark):
    docs = [document(f"{p}{n}", [reading(p, v)]) for p, values in (("bc", (1e21, 3e21)), ("no", (1e-9, 3e-9))) for n, v in enumerate(values)]
    trend = trend_by_hour(fresh_star(documents(spark, docs)))
    assert rows_of(trend, "parameter_name", "readings", "avg_value") == [("bc", 2, 2e21), ("no", 2, 2e-9)]


def test_trend_sums_do_not_depend_on_order(spark):
    """Values of all sizes and signs, whose plain sum changes with its order; merged in any portions."""
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-60, 60) for _ in range(3000)]
    values += [1e300, -1e300, 5e-324, -1e-300, 0.0, -0.0, 256.0, 65536.0, -1.0, 0.1, 0.2]
    odd = [None, float("nan"), float("inf")]
    facts = [(f"m{i}", 1, 4, 6, v, "x") for i, v in enumerate([*values, *odd])]
    parameter = spark.createDataFrame([(4, "co")], PARAMETER)
    time = spark.createDataFrame([(6, T, 2024, 7, 1, 14, 0, 0)], TIME)
    star = {PARAMETER_TABLE: parameter, TIME_TABLE: time}
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(facts)
        table = spark.createDataFrame(facts, FACT).repartition(3 + seed)
        (row,) = trend_by_hour({**star, FACT_TABLE: table}).collect()
        parts = [hourly_sums(spark.createDataFrame(part, FACT), time) for part in (facts[:1000], facts[1000:])]
        assert str(trend_of_sums(parts[0].unionByName(parts[1]), parameter).collect()) == str([row])
        seen.add((row.readings, row.avg_value, row.min_value))
    ((readings, average, least),) = seen
    assert readings == len(facts) and least == -1e300
    assert average == pytest.approx(math.fsum(values) / len(values), rel=1e-15)


def test_hot_timestamp_is_split(spark, tmp_path):
    """One timestamp holds most readings; adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.concat(F.lit("m"), F.col("id")).alias("measurement_id"),
            F.lit(1.0).alias("latitude"),
            F.col("id").cast("double").alias("longitude"),
            F.when(F.col("id") % 2 == 0, "co").otherwise("no2").alias("parameter_name"),
            F.col("id").cast("double").alias("value"),
            F.lit("x").alias("unit"),
            F.when(F.col("id") % 3 < 2, F.lit(T).cast("timestamp_ntz"))
            .otherwise(F.timestamp_add("SECOND", F.col("id"), F.lit(T).cast("timestamp_ntz")))
            .alias("timestamp"),
        )
        location, parameter, _ = _dims(spark)
        times = rows.select("timestamp").distinct()
        times.withColumn("time_id", F.hash("timestamp").cast("bigint")).write.parquet(str(tmp_path / "t"))
        time = spark.read.parquet(str(tmp_path / "t"))
        facts = build_facts(rows, location, parameter, time)
        assert facts.agg(F.count("time_id")).first()[0] == 60000
        facts.collect()
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
