"""Star tables in a database over Spark's JDBC source.

Reads and writes stay in the executors. URL and credentials are the caller's;
none are kept here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensormart.schemas import FACT, FACT_TABLE, ID_COLUMNS, NATURAL_KEYS, STAR


def id_ranges(least: int | None, greatest: int | None, parts: int, column: str) -> list[str]:
    """Predicates that read a table in ``parts`` tasks by ranges of its id: every row in just one.

    The first range is open below and takes missing ids, the last is open above, so
    rows that arrive between the look at the bounds and the read are not lost. Ids
    are contiguous, so equal ranges hold about equally many rows.
    """
    if least is None or greatest is None or parts < 2 or greatest == least:
        return ["1 = 1"]
    parts = min(parts, greatest - least + 1)
    cuts = [least + (greatest - least + 1) * n // parts for n in range(1, parts)]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def bounds_query(table: str) -> str:
    """The least and greatest id of a dimension, as a table for the source: one row."""
    column = ID_COLUMNS[table]
    return f"(SELECT MIN({column}) AS least, MAX({column}) AS greatest FROM {table}) bounds"


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict, predicates: list[str] | None = None, **options
) -> DataFrame:
    """A star table, in one task for each of ``predicates``.

    Or pass ``partitionColumn``, bounds and ``numPartitions``. Only the columns asked
    for later are read, and filters are pushed to the database.
    """
    names = [f.name for f in STAR[table].fields]
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=predicates, properties={**properties, **options}).select(*names)
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    return reader.options(**options).load().select(*names)


def read_keys(spark: SparkSession, url: str, table: str, properties: dict, **options) -> DataFrame:
    """Natural key and id of a dimension: what id resolution needs, and no more."""
    columns = [*NATURAL_KEYS[table], ID_COLUMNS[table]]
    return read_table(spark, url, table, properties, **options).select(*columns)


def append_rows(rows: DataFrame, url: str, table: str, properties: dict) -> None:
    """Append dimension rows."""
    rows.write.format("jdbc").mode("append").options(url=url, dbtable=table, **properties).save()


def stage_facts(facts: DataFrame, url: str, staging: str, properties: dict) -> str:
    """Write facts to a staging table; return the statement that merges it in the database.

    Spark's JDBC sink only inserts. The statement merges the staged rows as one
    set, in one transaction, and is run with the database's own client.
    """
    writer = facts.write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=staging, **properties).save()
    return merge_statement(staging)


def merge_statement(staging: str) -> str:
    """Insert staged facts, replacing all other columns where the key exists."""
    key = ID_COLUMNS[FACT_TABLE]
    columns = [f.name for f in FACT.fields]
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c != key)
    names = ", ".join(columns)
    return (
        f"INSERT INTO {FACT_TABLE} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({key}) DO UPDATE SET {updates}"
    )


class JdbcStar:
    """The star's tables in a database as the target of ``plans.load_into``.

    ``parts``: tasks that read a dimension's keys. ``statements`` collects what is
    still to be run with the database's own client.
    """

    def __init__(self, spark: SparkSession, url: str, properties: dict, parts: int = 8, staging: str = "staged_facts"):
        self.spark, self.url, self.properties = spark, url, properties
        self.parts, self.staging = parts, staging
        self.statements: list[str] = []

    def keys(self, table: str) -> DataFrame:
        """Natural keys and ids of a dimension, read side by side by ranges of the id."""
        reader = self.spark.read.format("jdbc").options(url=self.url, dbtable=bounds_query(table), **self.properties)
        bounds = reader.load().first()
        ranges = id_ranges(bounds.least, bounds.greatest, self.parts, ID_COLUMNS[table])
        return read_keys(self.spark, self.url, table, self.properties, predicates=ranges)

    def append(self, table: str, rows: DataFrame) -> None:
        append_rows(rows, self.url, table, self.properties)

    def merge_facts(self, facts: DataFrame) -> None:
        self.statements.append(stage_facts(facts, self.url, self.staging, self.properties))
