"""A small broadcast filter, for rows of which few have a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each mark, about, and at least and at most: the filter is never larger than some 32 MB.
BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 26


def _looked_up(rows: DataFrame, mark: str, marks: DataFrame, many: int, how: str) -> tuple[DataFrame, Column]:
    """``rows`` joined with the filter of ``marks``, and the condition that a mark's bit is set."""
    bits = max(LEAST_BITS, min(MOST_BITS, 1 << max(BITS * many - 1, 1).bit_length()))
    spot = F.pmod(F.col(marks.columns[0]), F.lit(bits))
    words = marks.filter(F.col(marks.columns[0]).isNotNull()).select(spot.alias("_spot"))
    words = words.groupBy(F.expr("shiftright(_spot, 6)").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_spot & 63 AS INT))")).alias("_bits")
    )
    placed = rows.withColumn("_spot", F.pmod(F.col(mark), F.lit(bits)))
    placed = placed.withColumn("_word", F.expr("shiftright(_spot, 6)"))
    return placed.join(F.broadcast(words), "_word", how), F.expr("getbit(_bits, CAST(_spot & 63 AS INT)) = 1")


def possible(rows: DataFrame, mark: str, marks: DataFrame, many: int) -> DataFrame:
    """The ``rows`` whose ``mark``, a 64-bit hash, may be among ``marks`` (one column, about ``many`` rows).

    Rows are not shuffled: the marks become bits, 64 in a row, which are broadcast. No
    row with a partner is lost; of the others one in 16 stays, or more where the marks
    outgrow the largest filter, so an exact join has to follow. A null mark has no partner.
    """
    found, is_set = _looked_up(rows, mark, marks, many, "inner")
    return found.filter(is_set).select(*rows.columns)


def flag_possible(rows: DataFrame, mark: str, marks: DataFrame, many: int, flag: str) -> DataFrame:
    """All ``rows``, and in the column ``flag`` whether ``possible`` would keep them; never null."""
    found, is_set = _looked_up(rows, mark, marks, many, "left")
    return found.select(*rows.columns, F.coalesce(is_set, F.lit(False)).alias(flag))
