"""Raw documents -> clean flat measurements. Everything here is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensormart.functions import (
    clamp,
    converted_value,
    epoch_seconds,
    harmonised_name,
    harmonised_unit,
    local_wall_clock,
    utc_wall_clock,
)
from sensormart.functions.time import LOCAL_ZONE
from sensormart.functions.units import PRESSURE_BAND
from sensormart.schemas import FLAT_COLUMNS


def unprocessed(docs: DataFrame) -> DataFrame:
    """Documents flagged as not processed. A missing flag does not count."""
    return docs.filter(~F.col("processed"))


def processed(docs: DataFrame) -> DataFrame:
    """Documents flagged as processed."""
    return docs.filter("processed")


def not_marked(docs: DataFrame) -> DataFrame:
    """Documents not marked as processed, those without a flag included."""
    return docs.filter(~F.col("processed").eqNullSafe(True))


def backfill_processed(docs: DataFrame) -> DataFrame:
    """A missing flag becomes false."""
    return docs.withColumn("processed", F.coalesce("processed", F.lit(False)))


def mark_processed(docs: DataFrame, batch: DataFrame) -> DataFrame:
    """Set the flag on the documents of ``batch`` (matched by ``_id.oid``), and only those."""
    done = batch.select(F.col("_id.oid").alias("_done")).distinct()
    return (
        docs.join(done, F.col("_id.oid") == F.col("_done"), "left")
        .withColumn("processed", F.when(F.col("_done").isNotNull(), True).otherwise(F.col("processed")))
        .drop("_done")
    )


def flatten_measurements(docs: DataFrame, *flags: str) -> DataFrame:
    """One row per reading; documents without readings give none.

    The key keeps the parameter's original spelling, ``parameter_name`` is
    lower-cased. ``last_updated`` is the instant as delivered, in text. ``flags``
    are further fields of a reading to keep (see ``mark_latest``); every document
    must have a reading then. For ``explode`` the optimizer would add a filter on
    the array's size and compute a derived array for it a second time.
    """
    oid, parameter = F.col("_id.oid"), F.col("m.parameter")
    key = F.concat_ws("_", oid, parameter)
    computed = {
        "measurement_id": F.when(oid.isNotNull() & parameter.isNotNull(), key),
        "parameter_name": F.lower(parameter),
    }
    one_each = F.explode_outer if flags else F.explode
    readings = docs.select("*", one_each("measurements").alias("m"))
    return readings.select(
        *[computed[n].alias(n) if n in computed else F.col(path).alias(n) for n, path in FLAT_COLUMNS.items()],
        *[F.col(f"m.{flag}").alias(flag) for flag in flags],
    )


def add_local_time(readings: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """``last_updated`` -> ``timestamp`` (clock in ``zone``) and ``observed_utc``, to the second."""
    return (
        readings.withColumn("_seconds", epoch_seconds(F.col("last_updated")))
        .withColumn("timestamp", local_wall_clock(F.col("_seconds"), zone))
        .withColumn("observed_utc", utc_wall_clock(F.col("_seconds")))
        .drop("_seconds", "last_updated")
    )


def harmonise_units(readings: DataFrame, strict: bool = False) -> DataFrame:
    """Convert values, relabel units, rename parameters, all from the row as delivered."""
    parameter, unit, value = F.col("parameter_name"), F.col("unit"), F.col("value")
    return readings.withColumns(
        {
            "value": converted_value(parameter, unit, value),
            "unit": harmonised_unit(parameter, unit, strict),
            "parameter_name": harmonised_name(parameter),
        }
    )


def clamp_pressure(
    readings: DataFrame, lo: float = PRESSURE_BAND[0], hi: float = PRESSURE_BAND[1]
) -> DataFrame:
    """Limit pressure readings (in Pa) to the plausible band."""
    return readings.withColumn(
        "value",
        F.when(F.col("parameter_name") == "pressure", clamp(F.col("value"), lo, hi)).otherwise(
            F.col("value")
        ),
    )


def clean_readings(flat: DataFrame, zone: str = LOCAL_ZONE, strict: bool = False) -> DataFrame:
    """Convert the time, harmonise, clamp."""
    return clamp_pressure(harmonise_units(add_local_time(flat, zone), strict))


def clean_measurements(
    docs: DataFrame,
    zone: str = LOCAL_ZONE,
    strict: bool = False,
    watch: Observation | None = None,
    flags: tuple[str, ...] = (),
) -> DataFrame:
    """Flatten and clean.

    ``watch`` receives ``readings`` and ``max_pressure`` (as delivered, before any
    conversion) from whichever action runs first, without a pass of its own.
    """
    flat = flatten_measurements(docs, *flags)
    if watch is not None:
        pressure = F.when(F.col("parameter_name") == "pressure", F.col("value"))
        flat = flat.observe(
            watch, F.count(F.lit(1)).alias("readings"), F.max(pressure).alias("max_pressure")
        )
    return clean_readings(flat, zone, strict)


def max_pressure(readings: DataFrame) -> DataFrame:
    """The greatest pressure reading, one row."""
    pressure = readings.filter(F.col("parameter_name") == "pressure")
    return pressure.agg(F.max("value").alias("max_value"))


def unusable_reason():
    """Why a clean reading cannot be stored, NULL when it can: it needs a key and a time."""
    return F.when(F.col("measurement_id").isNull(), "no key").when(
        F.col("timestamp").isNull(), "malformed time"
    )


def split_unusable(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected with ``reject_reason``)."""
    rejected = clean.withColumn("reject_reason", unusable_reason())
    return clean.filter(unusable_reason().isNull()), rejected.filter("reject_reason IS NOT NULL")
