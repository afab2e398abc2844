"""Star joins: clean readings + dimensions -> fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensormart.operators.clean import clean_measurements
from sensormart.operators.upsert import LATEST, latest_per_key, mark_latest

FACT_COLUMNS = ["measurement_id", "location_id", "parameter_id", "time_id", "value", "unit"]


def latest_readings(clean: DataFrame) -> DataFrame:
    """One reading per key, with the columns a fact needs and no others."""
    columns = ["measurement_id", "latitude", "longitude", "parameter_name", "timestamp"]
    return latest_per_key(clean.select(*columns, *LATEST))


def settled_readings(docs: DataFrame, strict: bool = False, watch: Observation | None = None) -> DataFrame:
    """Clean readings of documents with a flag ``latest``; filtered by it, one reading per key.

    As ``latest_readings``, for documents with distinct ids, without a shuffle: see
    ``mark_latest``. ``watch`` counts the readings as in ``clean_measurements``.
    """
    marked = mark_latest(docs.filter(F.size("measurements") > 0), strict)
    return clean_measurements(marked, strict=strict, watch=watch, flags=("latest",))


def build_facts(
    clean: DataFrame, location: DataFrame, parameter: DataFrame, time: DataFrame, extra: Sequence[str] = ()
) -> DataFrame:
    """Replace the natural keys by ids. A key that is NULL or unknown gives a NULL id.

    ``extra`` names further columns of ``clean`` to keep.

    The joins carry no broadcast hint. Each dimension is read from files or a
    written copy, so Spark knows its size and broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it shuffles, and
    adaptive execution splits a partition that one hot station or one hot
    timestamp makes too large.
    """
    return (
        clean.join(
            location.select("latitude", "longitude", "location_id"), ["latitude", "longitude"], "left"
        )
        .join(parameter.select("parameter_name", "parameter_id"), "parameter_name", "left")
        .join(time.select("timestamp", "time_id"), "timestamp", "left")
        .select(*FACT_COLUMNS, *extra)
    )
