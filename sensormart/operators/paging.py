"""Pages of the newest documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.functions import epoch_seconds

PAGE_SIZE = 100  # fixed value


def with_newest(docs: DataFrame) -> DataFrame:
    """Add ``newest``, a document's latest instant in epoch seconds, whatever offsets the texts have.

    Stored with the documents, it lets a page's filter reach the Parquet scan.
    """
    if "newest" in docs.columns:
        return docs
    return docs.withColumn("newest", F.array_max(F.transform("measurements", lambda m: epoch_seconds(m["lastUpdated"]))))


def page_after(docs: DataFrame, cursor: tuple[int | None, str] | None = None, limit: int = PAGE_SIZE) -> DataFrame:
    """The next documents after ``cursor``, newest reading first, then by id; without one, the first.

    A cursor is (newest, id) of the last document of the page before, see
    ``cursor_of``. A page costs the same however deep it lies: every task keeps
    ``limit`` rows, and documents newer than the cursor are filtered out by the
    scan where ``newest`` is stored. Documents without a time come last.
    """
    rows = with_newest(docs)
    if cursor is not None:
        newest, oid = cursor
        beyond = F.col("_id.oid") > oid
        if newest is None:
            rows = rows.filter(F.col("newest").isNull() & beyond)
        else:
            older = (F.col("newest") <= newest) & ((F.col("newest") < newest) | beyond)
            rows = rows.filter(older | F.col("newest").isNull())
    return rows.orderBy(F.desc_nulls_last("newest"), "_id.oid").limit(limit)


def cursor_of(page: DataFrame) -> tuple[int | None, str] | None:
    """Where the page ends; None when it has no rows. Looks at the page's rows only."""
    last = page.select("newest", F.col("_id.oid").alias("oid")).collect()[-1:]
    return (last[0].newest, last[0].oid) if last else None


def latest_page(docs: DataFrame, page: int = 1, limit: int = PAGE_SIZE) -> DataFrame:
    """Page ``page`` (from 1) of the documents, newest reading first, then by id.

    A document's age is its latest instant, whatever offsets the texts have. Only
    ids and instants are put in order, the top ones per task first; the documents
    of the page are then joined to its ids, of which there are ``limit``. Deep pages
    are better asked for with ``page_after``.
    """
    keys = (
        with_newest(docs)
        .select(F.col("_id.oid").alias("_oid"), F.col("newest").alias("_newest"))
        .orderBy(F.desc("_newest"), "_oid")
        .offset(limit * (page - 1))
        .limit(limit)
    )
    found = docs.join(F.broadcast(keys), F.col("_id.oid") == F.col("_oid"))
    return found.orderBy(F.desc("_newest"), "_oid").drop("_newest", "_oid")
