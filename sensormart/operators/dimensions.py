"""Dimension tables and their surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormart.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number below


def location_dim(clean: DataFrame) -> DataFrame:
    """One row per coordinate pair: the smallest (name, city, country) of the pair.

    ``distinct`` first: it is a hash aggregate that shrinks the readings to the
    few distinct stations before the shuffle, however often one station occurs.
    """
    described = clean.select("location_name", "city", "country", "latitude", "longitude").distinct()
    return (
        described.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
        .groupBy("latitude", "longitude")
        .agg(F.min(F.struct("location_name", "city", "country")).alias("s"))
        .select("s.location_name", "s.city", "s.country", "latitude", "longitude")
    )


def parameter_dim(clean: DataFrame) -> DataFrame:
    """One row per parameter name."""
    return clean.select("parameter_name").distinct().filter("parameter_name IS NOT NULL")


def time_dim(clean: DataFrame) -> DataFrame:
    """One row per local clock second, with its parts.

    The missing time is dropped by its count: a filter on the column itself would
    move below the aggregate, where each text would be parsed a second time.
    """
    return (
        clean.groupBy("timestamp")
        .agg(F.count("timestamp").alias("readings"))
        .filter("readings > 0")
        .select(
            "timestamp",
            F.year("timestamp").alias("year"),
            F.month("timestamp").alias("month"),
            F.dayofmonth("timestamp").alias("day"),
            F.hour("timestamp").alias("hour"),
            F.minute("timestamp").alias("minute"),
            F.second("timestamp").cast("int").alias("second"),
        )
    )


def number_rows(rows: DataFrame, keys: list[str], id_column: str, first: Column | int = 1) -> DataFrame:
    """Add contiguous bigint ids in the order of ``keys`` (which must be unique).

    A global row_number would sort everything in one task. Here the rows are
    range-partitioned and sorted within partitions, written once with their slot
    (partition, row), and each partition's start is the sum of the sizes before
    it. The copy is written because range bounds are sampled: a recomputation
    could place rows differently. Only one row per partition is broadcast.
    """
    slotted = materialise(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = slotted.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        "_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before")
    )
    first = first if isinstance(first, Column) else F.lit(first)
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        slotted.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*rows.columns, (first + F.col("_before") + row).cast("bigint").alias(id_column))
    )


def next_id(table: DataFrame, id_column: str) -> Column:
    """The first free id of a table, 1 when it is empty, as a scalar subquery."""
    return table.agg((F.coalesce(F.max(id_column), F.lit(0)) + 1).cast("bigint").alias("n")).scalar()


def resolve_ids(
    rows: DataFrame,
    existing: DataFrame,
    keys: list[str],
    id_column: str,
    new_flag: str | None = None,
) -> DataFrame:
    """Give every dimension row the id stored for its natural key, or the next free one.

    New ids follow the natural-key order, so the same batch always gets the same
    ids. New rows are sorted in front of known ones, which makes their rank
    contiguous and lets one written copy serve both. ``new_flag`` names a boolean
    column that tells them apart.
    """
    stored = existing.select(*keys, F.col(id_column).alias("_stored"))
    matched = rows.join(stored, keys, "left").withColumn("_known", F.col("_stored").isNotNull())
    ranked = number_rows(matched, ["_known", *keys], "_rank", first=0)
    flag = [] if new_flag is None else [(~F.col("_known")).alias(new_flag)]
    return ranked.select(
        F.coalesce("_stored", next_id(existing, id_column) + F.col("_rank")).alias(id_column),
        *[c for c in rows.columns if c != id_column],
        *flag,
    )


def new_dimension_rows(resolved: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose natural key is not stored yet."""
    return resolved.join(existing.select(*keys), keys, "left_anti")
