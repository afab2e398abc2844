from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensormart import functions
from sensormart.functions import epoch_seconds, local_wall_clock, utc_wall_clock, zoned_text

# text -> clock in Paris
CASES = [
    ("2024-07-01T12:00:00+00:00", datetime(2024, 7, 1, 14, 0)),
    ("2024-07-01T12:00:00.987Z", datetime(2024, 7, 1, 14, 0)),
    ("2024-01-15T23:30:00+02:00", datetime(2024, 1, 15, 22, 30)),
    ("2024-01-15T23:30:00-05:00", datetime(2024, 1, 16, 5, 30)),
    ("2024-03-31T00:59:59Z", datetime(2024, 3, 31, 1, 59, 59)),
    ("2024-03-31T01:00:00Z", datetime(2024, 3, 31, 3, 0)),
    ("2024-10-27T00:30:00Z", datetime(2024, 10, 27, 2, 30)),
    ("2024-10-27T01:30:00Z", datetime(2024, 10, 27, 2, 30)),
    ("2024-11-03T05:30:00Z", datetime(2024, 11, 3, 6, 30)),
    ("2024-11-03T06:30:00Z", datetime(2024, 11, 3, 7, 30)),
    ("2024-07-01T12:00:00", datetime(2024, 7, 1, 14, 0)),
    ("2024-07-01", datetime(2024, 7, 1, 2, 0)),
    (" 2024-07-01T12:00:00Z ", datetime(2024, 7, 1, 14, 0)),
    ("2024-07-01T12:00", datetime(2024, 7, 1, 14, 0)),
    ("2024-07-01 12:00+02:00", datetime(2024, 7, 1, 12, 0)),
    ("2024-07-01T12", datetime(2024, 7, 1, 14, 0)),
    ("2024-7-1", datetime(2024, 7, 1, 2, 0)),
    ("2024-07", datetime(2024, 7, 1, 2, 0)),
    ("2024", datetime(2024, 1, 1, 1, 0)),
    ("garbage", None),
    ("12:30:00Z", None),
    ("12:30", None),
    ("2024-13-01T00:00:00Z", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_local_clock_does_not_depend_on_the_session(spark, session_zone, zone):
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "n int, t string")
    session_zone(zone)
    local = local_wall_clock(epoch_seconds(F.col("t"))).alias("local")
    got = [r.local for r in frame.select("n", local).orderBy("n").collect()]
    assert got == [expected for _, expected in CASES]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_fold_keeps_the_instants_apart(spark, session_zone, zone):
    frame = spark.createDataFrame([("2024-10-27T00:30:00Z",), ("2024-10-27T01:30:00Z",)], "t string")
    session_zone(zone)
    utc = frame.select(utc_wall_clock(epoch_seconds(F.col("t"))).alias("u"))
    assert sorted(r.u for r in utc.collect()) == [datetime(2024, 10, 27, 0, 30), datetime(2024, 10, 27, 1, 30)]


def test_zoned_text(spark, session_zone):
    session_zone("UTC")
    frame = spark.createDataFrame([("2024-07-01T12:00:00+00:00",)], "t string")
    text = frame.select(zoned_text(local_wall_clock(epoch_seconds(F.col("t")))).alias("x"))
    assert text.first().x == "2024-07-01T14:00:00Z"


def test_other_zone(spark):
    frame = spark.createDataFrame([("2024-07-01T12:00:00+00:00",)], "t string")
    local = local_wall_clock(epoch_seconds(F.col("t")), "Asia/Tokyo").alias("x")
    assert frame.select(local).first().x == datetime(2024, 7, 1, 21, 0)


def test_text_with_the_offset_of_a_zone(spark, session_zone):
    """In any session zone: summer, winter, the hour that comes twice, zones behind UTC and with half hours."""
    session_zone("Asia/Tokyo")
    rows = [
        ("2024-07-01T12:00:00Z", "Europe/Paris", "2024-07-01T14:00:00+02:00"),
        ("2024-01-15T23:30:00Z", "Europe/Paris", "2024-01-16T00:30:00+01:00"),
        ("2024-07-01T12:00:00Z", "America/St_Johns", "2024-07-01T09:30:00-02:30"),
        ("2024-07-01T12:00:00Z", "Asia/Kolkata", "2024-07-01T17:30:00+05:30"),
        ("2024-07-01T12:00:00Z", "UTC", "2024-07-01T12:00:00Z"),
    ]
    for text, zone, expected in rows:
        local = functions.local_wall_clock(functions.epoch_seconds(F.lit(text)), zone)
        assert spark.range(1).select(functions.zoned_text(local, zone)).first()[0] == expected
