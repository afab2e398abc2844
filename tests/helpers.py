"""Small frames for tests."""

from pyspark.sql import DataFrame, SparkSession

from sensormart.schemas import RAW_DOCUMENT

NOON = "2024-07-01T12:00:00+00:00"


def reading(parameter="co", value=1.0, unit="µg/m³", at=NOON):
    return (parameter, value, unit, at)


def document(oid, measurements, location="s1", city="c", country="k", at=(1.0, 2.0), processed=False):
    return ((oid,), location, city, country, at, measurements, processed)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RAW_DOCUMENT)


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Sorted rows, with None in front."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])
