"""Documents as they are found: landed API response pages, stored raw documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensormart.schemas import ENVELOPE, RAW_DOCUMENT


def read_pages(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """One row per response: a file each (a page is at most 100 documents) or a line each.

    Files with a line per response can be split among tasks.
    """
    return spark.read.schema(ENVELOPE).option("multiLine", not one_per_line).json(path)


def read_documents(
    spark: SparkSession, path: str | None = None, source: str = "parquet", **options: str
) -> DataFrame:
    """Stored raw documents, with the fixed schema: nothing is inferred.

    A document store is read with its connector's name and options
    (``source="mongodb"``), when the connector is on the class path.
    """
    return spark.read.format(source).schema(RAW_DOCUMENT).options(**options).load(path)


def unnest_results(pages: DataFrame) -> DataFrame:
    """One row per document; a missing or empty ``results`` gives none."""
    return pages.select(F.explode("results").alias("doc")).select("doc.*")


def has_geo(docs: DataFrame) -> DataFrame:
    """Documents with both coordinates."""
    return docs.filter("coordinates.latitude IS NOT NULL AND coordinates.longitude IS NOT NULL")
