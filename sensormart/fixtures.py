"""Raw documents and star tables derived from the shared test tables.

``events``, ``nation`` and ``region`` become sensor readings: a station per
user, a document per station and block of 1,000 event numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormart.operators import (
    clean_measurements,
    location_dim,
    number_rows,
    parameter_dim,
    time_dim,
)
from sensormart.session import materialise
from sensormart.schemas import ID_COLUMNS, LOCATION_TABLE, NATURAL_KEYS, PARAMETER_TABLE

# Parameter and unit of an event, by event number modulo 28. The pairs touch
# every conversion and relabel rule, the gaps between them, and mixed case.
PAIRS = [
    ("co", "ppm"), ("co", "ppb"), ("no2", "ppm"), ("no2", "ppb"),
    ("so2", "ppm"), ("so2", "ppb"), ("o3", "ppb"), ("o3", "ppm"),
    ("pm25", "µg/m³"), ("pm10", "µg/m³"), ("pm4", "particles/cm³"), ("pm1", "µg/m³"),
    ("no", "ppm"), ("no", "ppb"), ("ch4", "ppm"), ("ch4", "ppb"),
    ("bc", "ng/m³"), ("pressure", "hpa"), ("pressure", "mb"), ("pressure", "pa"),
    ("temperature", "f"), ("temperature", "k"), ("temperature", "c"),
    ("relativehumidity", "%"), ("CO", "µg/m³"), ("PM25", "µg/m³"),
    ("Pressure", "hPa"), ("um010", "particles/cm³"),
]
STORED_PARAMETERS = ["co", "no2", "pm25", "pressure"]
ID_DIGITS = 12


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pad(number: Column) -> Column:
    return F.lpad(number.cast("string"), ID_DIGITS, "0")


def flat_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: a reading with its document's fields. No shuffle."""
    pairs = ", ".join(f"('{parameter}', '{unit}')" for parameter, unit in PAIRS)
    pair = F.expr(f"element_at(array({pairs}), CAST(event_id % {len(PAIRS)} + 1 AS INT))")
    block = F.expr("event_id div 1000")
    half = F.expr("user_id div 2")
    rows = F.expr("(user_id div 2) div 75")
    day = F.expr("ts + make_dt_interval(CAST(event_id % 366 AS INT))").cast("string")
    value = (
        F.when(F.lower("parameter").eqNullSafe("pressure") & (F.col("unit") != "pa"), F.lit(850) + F.col("value"))
        .when(F.col("unit") == "pa", F.col("value") * 1000)
        .otherwise(F.col("value"))
    )
    return (
        _table(spark, sf_dir, "events")
        .withColumn("pair", pair)
        .withColumn("parameter", F.col("pair.col1"))
        .withColumn("unit", F.col("pair.col2"))
        .join(_table(spark, sf_dir, "nation"), F.col("user_id") % 25 == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            block.alias("block"),
            "user_id",
            F.concat(F.lit("doc"), _pad(block), _pad(F.col("user_id"))).alias("doc_id"),
            F.concat(F.lit("station-"), F.col("user_id").cast("string")).alias("location"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            ((half % 75).cast("double") * 0.5 - 18.5).alias("latitude"),
            ((half % 75 + rows * 4).cast("double") - 37.0).alias("longitude"),
            "parameter",
            value.alias("value"),
            "unit",
            F.concat(
                F.substring(day, 1, 10), F.lit("T"), F.substring(day, 12, 8), F.lit("+00:00")
            ).alias("lastUpdated"),
        )
    )


def as_documents(flat: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Nest flat readings into raw documents of at most 1,000 readings each."""
    keys = [*(extra or []), "doc_id", "location", "city", "country", "latitude", "longitude"]
    measurement = F.struct("parameter", "value", "unit", "lastUpdated")
    return (
        flat.groupBy(*keys)
        .agg(F.collect_list(measurement).alias("measurements"))
        .select(
            *(extra or []),
            F.struct(F.col("doc_id").alias("oid")).alias("_id"),
            "location",
            "city",
            "country",
            F.struct("latitude", "longitude").alias("coordinates"),
            "measurements",
            F.lit(False).alias("processed"),
        )
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_documents(flat_readings(spark, sf_dir))


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``flatten_measurements`` gives for ``documents``, without nesting first: no shuffle."""
    return flat_readings(spark, sf_dir).select(
        F.concat("doc_id", F.lit("_"), "parameter").alias("measurement_id"),
        "city",
        "country",
        F.col("location").alias("location_name"),
        "latitude",
        "longitude",
        F.lower("parameter").alias("parameter_name"),
        "value",
        "unit",
        F.col("lastUpdated").alias("last_updated"),
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, written once."""
    return materialise(documents(spark, sf_dir), "documents")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean readings of the documents, which are landed once and flattened from there."""
    return clean_measurements(landed(spark, sf_dir))


def preloaded_dimension(readings: DataFrame, table: str) -> DataFrame:
    """A dimension table that already holds part of the keys, numbered from 1."""
    if table == LOCATION_TABLE:
        stored = location_dim(readings).filter("(latitude + 18.5) * 2 % 2 = 0")
    elif table == PARAMETER_TABLE:
        stored = parameter_dim(readings).filter(F.col("parameter_name").isin(*STORED_PARAMETERS))
    else:
        stored = time_dim(readings).filter("hour < 12")
    return number_rows(stored, NATURAL_KEYS[table], ID_COLUMNS[table])


def history_and_redelivery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(incoming, stored): about half of the documents are stored; all come again, in

    three variants: unchanged, only the parameters below 'p', every value plus 1.
    """
    docs = materialise(as_documents(flat_readings(spark, sf_dir), ["block", "user_id"]), "documents")
    stored = docs.filter("(block + user_id) % 2 = 0").drop("block", "user_id")
    docs = docs.drop("block", "user_id")
    below_p = F.filter("measurements", lambda m: m["parameter"] < "p")
    plus_one = F.transform("measurements", lambda m: m.withField("value", m["value"] + 1))
    variants = F.array(
        F.struct(F.lit("-v0").alias("suffix"), F.col("measurements")),
        F.struct(F.lit("-v1").alias("suffix"), below_p.alias("measurements")),
        F.struct(F.lit("-v2").alias("suffix"), plus_one.alias("measurements")),
    )
    incoming = docs.withColumn("v", F.explode(variants)).select(
        F.struct(F.concat("_id.oid", "v.suffix").alias("oid")).alias("_id"),
        "location",
        "city",
        "country",
        "coordinates",
        "v.measurements",
        "processed",
    )
    return incoming, stored
