"""Queries on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormart.schemas import FACT_TABLE, PARAMETER_TABLE, TIME_TABLE
from sensormart.sources.store import HOURLY_TABLE, StarStore

HOUR = ["year", "month", "day", "hour"]
#: Bits of a bin of exponents, the lowest bin, and the bits of the lower half of a sum.
_WIDTH, _LOWEST, _HALF = 8, -121, 30


def _bin(value: Column) -> Column:
    """The bin of a value's exponent; NULL for zero and values that are not finite.

    The addend keeps powers of two on one side, whatever the last bit of the logarithm.
    """
    finite = F.abs(value) < F.lit(float("inf"))
    exponent = F.floor((F.log2(F.abs(value)) + F.lit(1e-9)) / _WIDTH).cast("int")
    return F.when(finite & (value != 0), F.greatest(exponent, F.lit(_LOWEST)))


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def hourly_sums(facts: DataFrame, time: DataFrame) -> DataFrame:
    """Mergeable sums per parameter, unit, local hour and bin of exponents.

    Inside a bin a value is a whole number of units of the bin, below 2**61, so its
    sum (``high`` * 2**30 + ``low``) is exact and does not depend on the order in
    which partitions, or loads, arrive. ``n`` counts readings, ``finite`` those that
    are summed. Facts are summed per id pair before the join: the map tasks combine
    the rows of one timestamp, so a timestamp shared by a third of all readings does
    not pile up, and the join sees far fewer rows.
    """
    bin_ = _bin(F.col("value"))
    whole = (F.col("value") * _power(53 - _WIDTH * F.col("bin"))).cast("long")
    finite = F.when(F.abs("value") < F.lit(float("inf")), F.col("value"))
    per_second = (
        facts.filter("parameter_id IS NOT NULL AND time_id IS NOT NULL")
        .select("parameter_id", "time_id", "unit", "value", bin_.alias("bin"))
        .withColumn("whole", whole)
        .groupBy("parameter_id", "time_id", "unit", "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(finite).alias("finite"),
            F.sum(F.shiftright("whole", _HALF)).alias("high"),
            F.sum(F.col("whole").bitwiseAND(F.lit((1 << _HALF) - 1))).alias("low"),
            F.min("value").alias("least"),
            F.max("value").alias("greatest"),
        )
    )
    return _merged(per_second.join(time.select("time_id", *HOUR), "time_id"))


def _merged(sums: DataFrame) -> DataFrame:
    added = [F.sum(c).alias(c) for c in ("n", "finite", "high", "low")]
    bounds = [F.min("least").alias("least"), F.max("greatest").alias("greatest")]
    return sums.groupBy("parameter_id", "unit", *HOUR, "bin").agg(*added, *bounds)


def trend_of_sums(sums: DataFrame, parameter: DataFrame) -> DataFrame:
    """The trend from ``hourly_sums``: of one star, or of several loads together."""
    merged = _merged(sums)
    high = F.col("high") + F.shiftright("low", _HALF)
    low = F.col("low").bitwiseAND(F.lit((1 << _HALF) - 1))
    total = (high.cast("double") * float(1 << _HALF) + low.cast("double")) * _power(_WIDTH * F.col("bin") - 53)
    part = F.when(F.col("bin").isNotNull(), F.struct((-F.col("bin")).alias("place"), total.alias("total")))
    # A handful of bins, added from the largest down.
    summed = F.aggregate(F.sort_array(F.collect_list(part)), F.lit(0.0), lambda a, p: a + p["total"])
    return (
        merged.groupBy("parameter_id", "unit", *HOUR)
        .agg(
            F.sum("n").alias("readings"),
            F.sum("finite").alias("finite"),
            summed.alias("total"),
            F.min("least").alias("min_value"),
            F.max("greatest").alias("max_value"),
        )
        .join(parameter, "parameter_id")
        .select(
            "parameter_name",
            "unit",
            *HOUR,
            "readings",
            F.try_divide("total", "finite").alias("avg_value"),
            "min_value",
            "max_value",
        )
    )


def trend_by_hour(star: dict[str, DataFrame], months: list[tuple[int, int]] | None = None) -> DataFrame:
    """Readings per parameter, unit and local hour: count, average, least, greatest.

    Every stored fact is a reading; the average is over the finite values, from an
    exact sum, so reruns agree to the last bit. ``months``: only these (year, month).
    Facts that are stored by month (``StarStore.star``) are then read from those
    folders only.
    """
    facts, time = star[FACT_TABLE], star[TIME_TABLE].select("time_id", *HOUR)
    if months is not None:
        wanted = _months(months)
        time = time.filter((F.col("year") * 100 + F.col("month")).isin(wanted))
        if "month" in facts.columns:
            facts = facts.filter(F.col("month").isin(wanted))
    return trend_of_sums(hourly_sums(facts, time), star[PARAMETER_TABLE])


def stored_trend(store: StarStore, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """``trend_by_hour`` of a store, from the sums that every load has written: no fact is read.

    Sums cannot take a value back, so once a load has replaced older facts, the facts
    are read after all.
    """
    if store.has_replaced():
        return trend_by_hour(store.star(), months)
    sums = store.table(HOURLY_TABLE)
    if months is not None:
        sums = sums.filter((F.col("year") * 100 + F.col("month")).isin(_months(months)))
    return trend_of_sums(sums, store.table(PARAMETER_TABLE))


def _months(months: list[tuple[int, int]]) -> list[int]:
    return [year * 100 + month for year, month in months]
