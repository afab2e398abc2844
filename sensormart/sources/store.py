"""Star schema and raw history as Parquet tables under one folder.

Every table is partitioned by the step that wrote it. A step's rows count once
its note is there: one row under ``published``, written last, which also says
what the step has landed or loaded. So a failed step leaves nothing visible, all
tables change together, and a repeated step is recognised by name. Everything
else is Spark's: tables are read by joining the notes. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from sensormart.schemas import FACT, FACT_TABLE, RAW_DOCUMENT, STAR, empty_frame
from sensormart.session import file_system

RAW_TABLE = "raw_data"
REJECT_TABLE = "rejects"
#: Facts that a later step has replaced.
REPLACED_TABLE = "replaced_facts"
#: What a load adds to the trend, see ``plans.serving``.
HOURLY_TABLE = "hourly_sums"
PUBLISHED = "published"

RAW_STORED = StructType(
    [
        *RAW_DOCUMENT.fields,
        StructField("content", StringType(), True),
        StructField("content_size", IntegerType(), True),
        StructField("first_updated", StringType(), True),
        StructField("last_updated", StringType(), True),
        StructField("station", LongType(), True),
        StructField("bucket", IntegerType(), True),
    ]
)
FACT_STORED = StructType([*FACT.fields, StructField("month", IntegerType(), True)])
REJECTED = StructType().add("raw", StringType()).add("reject_reason", StringType())
HOURLY = StructType(
    [
        StructField("parameter_id", LongType(), True),
        StructField("unit", StringType(), True),
        *[StructField(c, IntegerType(), True) for c in ("year", "month", "day", "hour", "bin")],
        *[StructField(c, LongType(), True) for c in ("n", "finite", "high", "low")],
        *[StructField(c, DoubleType(), True) for c in ("least", "greatest")],
    ]
)
REPLACED = StructType().add("measurement_id", StringType()).add("replaced_step", StringType())

SCHEMAS = {
    **STAR,
    FACT_TABLE: FACT_STORED,
    RAW_TABLE: RAW_STORED,
    REJECT_TABLE: REJECTED,
    REPLACED_TABLE: REPLACED,
    HOURLY_TABLE: HOURLY,
}
#: Folders inside a step's folder: the history by station, facts by month.
FOLDERS = {RAW_TABLE: ["bucket"], FACT_TABLE: ["month"]}
#: A note: has the step landed documents, which landings has it loaded, its range of fact keys,
#: and what it counted.
NOTE = (
    StructType()
    .add("lands", BooleanType())
    .add("loads", ArrayType(StringType()))
    .add("least", StringType())
    .add("greatest", StringType())
    .add("counts", MapType(StringType(), DoubleType()))
    .add("step", StringType())
)


class StarStore:
    """Paths, notes and tables of one store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _exists(self, path: str) -> bool:
        files, target = file_system(self.spark, path)
        return files.exists(target)

    # -- steps ---------------------------------------------------------------
    def committed(self, step: str) -> bool:
        """Is this step published?"""
        return self._exists(f"{self.root}/{PUBLISHED}/step={step}/_SUCCESS")

    def publish(self, step: str, counts: dict | None = None, **note) -> None:
        """Write the step's note: the point where all it has written takes effect.

        ``note`` holds ``lands``, ``loads``, ``least`` and ``greatest``, where they apply;
        ``counts`` are numbers that the step has observed.
        """
        known = [v for name, n in (counts or {}).items() if n is not None for v in (F.lit(name), F.lit(float(n)))]
        values = {f.name: F.lit(note.get(f.name)) for f in NOTE.fields[:-2]} | {"counts": F.create_map(*known)}
        columns = [values[f.name].cast(f.dataType).alias(f.name) for f in NOTE.fields[:-1]]
        one = self.spark.range(1).coalesce(1).select(*columns)
        one.write.mode("overwrite").parquet(f"{self.root}/{PUBLISHED}/step={step}")

    def notes(self) -> DataFrame:
        """One row per published step."""
        if not self._exists(f"{self.root}/{PUBLISHED}"):
            return empty_frame(self.spark, NOTE)
        return self.spark.read.schema(NOTE).parquet(f"{self.root}/{PUBLISHED}")

    def counts(self) -> DataFrame:
        """What every step has counted: ``step``, ``name``, ``value``."""
        return self.notes().select("step", F.explode("counts").alias("name", "value"))

    def has_landed(self) -> bool:
        """Is there a history at all?"""
        return not self.notes().filter("lands").isEmpty()

    def loaded_steps(self) -> DataFrame:
        """The landings that are loaded (``step``)."""
        return self.notes().select(F.explode("loads").alias("step"))

    def pending(self) -> list[str]:
        """Landings not loaded yet, in order: what is outstanding, however long the history is."""
        landed = self.notes().filter("lands").select("step")
        return sorted(row.step for row in landed.join(self.loaded_steps(), "step", "left_anti").collect())

    # -- tables --------------------------------------------------------------
    def write(self, table: str, step: str, rows: DataFrame) -> None:
        """Write a step's rows of a table; they stay invisible until it is published."""
        columns = [f.name for f in SCHEMAS[table].fields]
        writer = rows.select(*columns).write.mode("overwrite").partitionBy(*FOLDERS.get(table, []))
        writer.parquet(f"{self.root}/{table}/step={step}")

    def begin(self, step: str) -> None:
        """Remove what an earlier attempt at the step has left, before any table is read."""
        for table in SCHEMAS:
            self.discard(table, step)

    def discard(self, table: str, step: str) -> None:
        """Remove what a step has written of a table, if anything."""
        files, target = file_system(self.spark, f"{self.root}/{table}/step={step}")
        files.delete(target, True)

    def read(self, table: str, steps: list[str]) -> DataFrame:
        """The rows of some steps, published or not, with a ``step`` column."""
        return self._all(table).filter(F.col("step").isin(steps))

    def _all(self, table: str) -> DataFrame:
        schema = StructType(list(SCHEMAS[table].fields)).add("step", "string")
        if not self._exists(f"{self.root}/{table}"):
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")

    def visible(self, table: str) -> DataFrame:
        """The published rows of a table, with a ``step`` column.

        Raw documents show in ``processed`` whether their landing is loaded. Facts
        replaced by a later step are left out.
        """
        rows = self._all(table).join(self.notes().select("step"), "step", "left_semi")
        if table == RAW_TABLE:
            done = self.loaded_steps().distinct().withColumn("_done", F.lit(True))
            rows = rows.join(done, "step", "left").withColumn("processed", F.coalesce("_done", "processed")).drop("_done")
        if table == FACT_TABLE and self.has_replaced():
            replaced = self.visible(REPLACED_TABLE).select("measurement_id", F.col("replaced_step").alias("step"))
            rows = rows.join(replaced, ["measurement_id", "step"], "left_anti")
        return rows

    def table(self, table: str) -> DataFrame:
        """A table's rows, in the order of its columns."""
        return self.visible(table).select(*[f.name for f in SCHEMAS[table].fields])

    def has_replaced(self) -> bool:
        """Has a step replaced facts of an earlier one?"""
        return self._exists(f"{self.root}/{REPLACED_TABLE}")

    def star(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in STAR}
