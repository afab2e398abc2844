"""Integrity rules of the star schema as counts of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.schemas import FACT_TABLE, ID_COLUMNS, NATURAL_KEYS


def _repeated(table: DataFrame, keys: list[str]) -> DataFrame:
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return table.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def repeated_keys(table: DataFrame, keys: list[str], reason: str) -> DataFrame:
    """Keys found more than once, as ``raw`` (JSON) and ``reject_reason``."""
    return _repeated(table, keys).select(F.to_json(F.struct(*keys)).alias("raw"), F.lit(reason).alias("reject_reason"))


def dangling_ids(facts: DataFrame, dimension: DataFrame, id_column: str) -> DataFrame:
    """Rows whose id is not in the dimension. Counted per id first: ids are few, facts many."""
    used = facts.filter(F.col(id_column).isNotNull()).groupBy(id_column)
    return used.agg(F.count(F.lit(1)).alias("n")).join(
        dimension.select(id_column), id_column, "left_anti"
    )


def integrity_violations(star: dict[str, DataFrame]) -> DataFrame:
    """One row per rule: ``table_name``, ``rule``, ``violations`` (0 when it holds).

    Unique rules count repeated keys (NULL keys are free, as in SQL); reference
    rules count fact rows.
    """
    results = []

    def add(table: str, rule: str, offenders: DataFrame, measure) -> None:
        counted = offenders.agg(F.coalesce(measure, F.lit(0)).cast("bigint").alias("violations"))
        results.append(
            counted.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations")
        )

    one_each = F.count(F.lit(1))
    for table, keys in NATURAL_KEYS.items():
        add(table, "natural key unique", _repeated(star[table], keys), one_each)
    for table, id_column in ID_COLUMNS.items():
        add(table, "primary key unique", _repeated(star[table], [id_column]), one_each)
    for table in NATURAL_KEYS:
        id_column = ID_COLUMNS[table]
        dangling = dangling_ids(star[FACT_TABLE], star[table], id_column)
        add(FACT_TABLE, f"{id_column} resolves", dangling, F.sum("n"))
    return reduce(DataFrame.unionByName, results)
