"""Keyed merge of fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormart.functions import (
    clamp,
    converted_value,
    epoch_seconds,
    harmonised_unit,
)
from sensormart.functions.units import PRESSURE_BAND

# Which of several readings under one key in one batch is kept: the latest
# instant, then the greatest value, then the greatest unit.
LATEST = ["observed_utc", "value", "unit"]


def latest_per_key(rows: DataFrame, key: str = "measurement_id", order: list[str] = LATEST) -> DataFrame:
    """One row per key, the greatest by ``order``.

    An aggregate and not a row_number window: each map task keeps one row per
    key, so a key with a third of all rows does not land in one task.
    """
    others = [c for c in rows.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *others)).alias("_best")
    return rows.groupBy(key).agg(best).select(key, "_best.*").select(*rows.columns)


def mark_latest(docs: DataFrame, strict: bool = False) -> DataFrame:
    """Give every reading of ``measurements`` a flag ``latest``: does it win its key?

    A key is a document's id and a parameter as spelled, so it never leaves its
    document, and its winner is found inside the array, without a shuffle: the
    readings are sorted by parameter, instant, clean value and clean unit (the order
    of ``latest_per_key``), and the last of each parameter wins. Only documents that
    name a parameter twice are sorted. No reading is dropped; a missing parameter
    has one winner too, as has a missing time that stands alone.
    """
    _, value, unit = LATEST

    def placed(m: Column) -> Column:
        name = F.lower(m["parameter"])
        converted = converted_value(name, m["unit"], m["value"])
        clean = F.when(name == "pressure", clamp(converted, *PRESSURE_BAND)).otherwise(converted)
        return F.struct(
            m["parameter"].alias("parameter"),
            epoch_seconds(m["lastUpdated"]).alias("at"),
            clean.alias(value),
            harmonised_unit(name, m["unit"], strict).alias(unit),
            m.alias("m"),
        )

    def flagged(m: Column, latest: Column) -> Column:
        fields = ("parameter", "value", "unit", "lastUpdated")
        return F.struct(*[m[f].alias(f) for f in fields], latest.alias("latest"))

    named = F.array_distinct(F.transform("measurements", lambda m: m["parameter"]))
    repeats = F.size(named) < F.size("measurements")
    # A column of its own, so that it is sorted once and not for every element.
    ordered = docs.withColumn("_sorted", F.when(repeats, F.array_sort(F.transform("measurements", placed))))

    def wins(x: Column, i: Column) -> Column:
        following = F.get("_sorted", i + 1)
        last = i == F.size("_sorted") - 1
        return flagged(x["m"], last | ~x["parameter"].eqNullSafe(following["parameter"]))

    return ordered.withColumn(
        "measurements",
        F.when(F.col("_sorted").isNotNull(), F.transform("_sorted", wins)).otherwise(
            F.transform("measurements", lambda m: flagged(m, F.lit(True)))
        ),
    ).drop("_sorted")


def first_per_reading(clean: DataFrame) -> DataFrame:
    """One row per (key, parameter, time): the one with the smallest value, then unit."""
    keys = ["measurement_id", "parameter_name", "timestamp"]
    others = [c for c in clean.columns if c not in [*keys, "value", "unit"]]
    smallest = F.min(F.struct("value", "unit", *others)).alias("_first")
    return clean.groupBy(*keys).agg(smallest).select(*keys, "_first.*").select(*clean.columns)


def upsert_facts(target: DataFrame, source: DataFrame, key: str = "measurement_id") -> DataFrame:
    """The target after the merge. A source row always replaces the stored one.

    ``source`` must hold one row per key (``latest_per_key``).
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.unionByName(source.select(*target.columns))
