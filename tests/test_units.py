import pytest
from pyspark.sql import functions as F

from sensormart.operators import clamp_pressure, harmonise_units

MICRO = "µg/m³"

# parameter, unit, value -> name, value, unit
CASES = [
    ("co", "ppm", 2.0, "co", 2 * 1145.94, MICRO),
    ("co", "ppb", 2.0, "co", 2 * 1.14594, MICRO),
    ("no2", "ppm", 2.0, "no2", 2 * 1912.87, MICRO),
    ("no2", "ppb", 2.0, "no2", 2 * 1.91287, MICRO),
    ("so2", "ppm", 2.0, "so2", 2 * 2620.8, MICRO),
    ("so2", "ppb", 2.0, "so2", 2 * 2.6208, MICRO),
    ("o3", "ppb", 2.0, "o3", 4.0, MICRO),
    ("no", "ppm", 2.0, "no", 2460.0, MICRO),
    ("no", "ppb", 2.0, "no", 2.46, MICRO),
    ("ch4", "ppm", 2.0, "ch4", 2 * 655.66, MICRO),
    ("pm25", MICRO, 2.0, "pm25", 2.0, MICRO),
    ("pm1", MICRO, 2.0, "pm1", 2.0, MICRO),
    ("pm1", "ng/m³", 2.0, "pm1", 2.0, "ng/m³"),
    ("pressure", "hpa", 1013.0, "pressure", 101300.0, "Pa"),
    ("pressure", "mb", 1013.0, "pressure", 101300.0, "Pa"),
    ("pressure", "pa", 101300.0, "pressure", 101300.0, "pa"),
    ("pressure", "hPa", 1013.0, "pressure", 1013.0, "hPa"),
    ("temperature", "f", 50.0, "temperature", 10.0, "°C"),
    ("temperature", "k", 300.0, "temperature", 300.0 - 273.15, "°C"),
    ("temperature", "c", 20.0, "temperature", 20.0, "°C"),
    ("relativehumidity", "%", 40.0, "humidity", 40.0, "%"),
    ("um010", "particles/cm³", 3.0, "um010", 3.0, "particles/cm³"),
    ("co", None, 2.0, "co", 2.0, None),
    (None, "ppm", 2.0, None, 2.0, "ppm"),
    ("co", "ppm", None, "co", None, MICRO),
]
# Relabelled although nothing was converted; strict keeps the unit.
GAPS = [
    ("o3", "ppm", 2.0, "o3", 2.0, MICRO),
    ("ch4", "ppb", 2.0, "ch4", 2.0, MICRO),
    ("bc", "ng/m³", 2.0, "bc", 2.0, MICRO),
    ("pm4", "particles/cm³", 2.0, "pm4", 2.0, MICRO),
    ("pm25", None, 2.0, "pm25", 2.0, MICRO),
]
SCHEMA = "n int, parameter_name string, unit string, value double"


def _run(spark, cases, strict):
    rows = [(n, p, u, v) for n, (p, u, v, *_) in enumerate(cases)]
    result = harmonise_units(spark.createDataFrame(rows, SCHEMA), strict).orderBy("n")
    return [(r.parameter_name, r.value, r.unit) for r in result.collect()]


@pytest.mark.parametrize("strict", [False, True])
def test_conversion_rules(spark, strict):
    assert _run(spark, CASES, strict) == [case[3:] for case in CASES]


def test_gaps_are_relabelled(spark):
    assert _run(spark, GAPS, strict=False) == [case[3:] for case in GAPS]


def test_strict_leaves_gaps_alone(spark):
    assert _run(spark, GAPS, strict=True) == [(c[3], c[4], c[1]) for c in GAPS]


def test_micro_sign_is_the_latin_one():
    assert MICRO[0] == "µ"


@pytest.mark.parametrize("clamp", [clamp_pressure])
def test_pressure_band(spark, clamp):
    values = [86999.99, 87000.0, 100000.0, 108400.0, 108400.01, None]
    rows = [(f"p{i}", "pressure", v) for i, v in enumerate(values)] + [("t", "temperature", 5.0)]
    frame = spark.createDataFrame(rows, "measurement_id string, parameter_name string, value double")
    got = [r.value for r in clamp(frame).orderBy("measurement_id").collect()]
    assert got == [87000.0, 87000.0, 100000.0, 108400.0, 108400.0, None, 5.0]


def test_no_python_in_the_plan(spark):
    frame = spark.range(5).select(
        F.lit("co").alias("parameter_name"), F.lit("ppm").alias("unit"), F.col("id").cast("double").alias("value")
    )
    plan = harmonise_units(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
