"""Fixed schemas of the raw documents and of the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


MEASUREMENT = _struct(
    ("parameter", StringType()),
    ("value", DoubleType()),
    ("unit", StringType()),
    ("lastUpdated", StringType()),
)
COORDINATES = _struct(("latitude", DoubleType()), ("longitude", DoubleType()))

# A document as it travels on the topic: no id, no processing flag.
MESSAGE = _struct(
    ("location", StringType()),
    ("city", StringType()),
    ("country", StringType()),
    ("coordinates", COORDINATES),
    ("measurements", ArrayType(MEASUREMENT)),
)
# A document as stored: MESSAGE plus its id and the processing flag.
RAW_DOCUMENT = StructType(
    [StructField("_id", _struct(("oid", StringType())), True)]
    + MESSAGE.fields
    + [StructField("processed", BooleanType(), True)]
)
# The columns of a flat reading, and where they lie in a document
# with one reading ``m``. Without a place: computed from the parameter.
FLAT_COLUMNS = {
    "measurement_id": None,
    "city": "city",
    "country": "country",
    "location_name": "location",
    "latitude": "coordinates.latitude",
    "longitude": "coordinates.longitude",
    "parameter_name": None,
    "value": "m.value",
    "unit": "m.unit",
    "last_updated": "m.lastUpdated",
}
ENVELOPE = _struct(("results", ArrayType(RAW_DOCUMENT)))

# The star schema's table and column names.
LOCATION_TABLE = "dimension_location"
PARAMETER_TABLE = "dimension_parameter"
TIME_TABLE = "dimension_time"
FACT_TABLE = "air_quality_measurements"

LOCATION = _struct(
    ("location_id", LongType()),
    ("location_name", StringType()),
    ("city", StringType()),
    ("country", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)
PARAMETER = _struct(("parameter_id", LongType()), ("parameter_name", StringType()))
TIME = _struct(
    ("time_id", LongType()),
    ("timestamp", TimestampNTZType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day", IntegerType()),
    ("hour", IntegerType()),
    ("minute", IntegerType()),
    ("second", IntegerType()),
)
FACT = _struct(
    ("measurement_id", StringType()),
    ("location_id", LongType()),
    ("parameter_id", LongType()),
    ("time_id", LongType()),
    ("value", DoubleType()),
    ("unit", StringType()),
)

STAR = {
    LOCATION_TABLE: LOCATION,
    PARAMETER_TABLE: PARAMETER,
    TIME_TABLE: TIME,
    FACT_TABLE: FACT,
}
NATURAL_KEYS = {
    LOCATION_TABLE: ["latitude", "longitude"],
    PARAMETER_TABLE: ["parameter_name"],
    TIME_TABLE: ["timestamp"],
}
ID_COLUMNS = {
    LOCATION_TABLE: "location_id",
    PARAMETER_TABLE: "parameter_id",
    TIME_TABLE: "time_id",
    FACT_TABLE: "measurement_id",
}


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and known to the optimizer as such: joins with it fold away."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """The star table before the first load."""
    return empty_frame(spark, STAR[table])
