"""Load: unprocessed raw documents -> dimensions and facts."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sensormart.operators import (
    build_facts,
    clean_measurements,
    resolve_ids,
    settled_readings,
    split_unusable,
    unprocessed,
    unusable_reason,
)
from sensormart.operators.integrity import dangling_ids, repeated_keys
from sensormart.plans.serving import hourly_sums
from sensormart.plans.star import for_each_dimension
from sensormart.schemas import FACT_TABLE, ID_COLUMNS, NATURAL_KEYS, STAR, TIME_TABLE
from sensormart.session import materialise, scratch
from sensormart.sources.store import HOURLY_TABLE, RAW_TABLE, REJECT_TABLE, REPLACED_TABLE, StarStore


class IntegrityError(ValueError):
    """A step broke a rule of the star schema, and was not published."""


def load_pending(store: StarStore) -> dict[str, int | float | None]:
    """Load every landing that is not loaded yet, as one atomic step.

    The clean readings are not cached. Each dimension reads only its own columns
    of the landed Parquet, so the four passes together scan little more than one
    full pass would, and nothing is lost with an executor. A key's readings are
    settled inside its document, so facts are joined without a shuffle by key.
    Returns what the load observed: ``readings``, ``max_pressure``, ``unusable``, and
    for each dimension the rows of the batch (``<table>_rows``) and those of them
    that were new (``<table>_new``). Empty when nothing was pending.

    Before the step is published, the rules of the star are checked (see
    ``_faults``). If one is broken, only the rows at fault are published, as
    rejects, and ``IntegrityError`` is raised; the landings stay pending.
    """
    landings = store.pending()
    if not landings:
        return {}
    step = f"load-{landings[0]}-{landings[-1]}"
    store.begin(step)
    with scratch():
        documents = unprocessed(store.read(RAW_TABLE, landings))
        clean = clean_measurements(documents)

        loaded = for_each_dimension(
            lambda table, extract: _load_dimension(store, table, extract(clean), step)
        )
        dimensions = {table: resolved for table, (resolved, _) in loaded.items()}
        seen = {f"{table}_{name}": n for table, (_, found) in loaded.items() for name, n in found.items()}

        flat_counts, clean_counts = Observation(), Observation()
        watched = settled_readings(documents, watch=flat_counts).observe(
            clean_counts, F.count(unusable_reason()).alias("unusable")
        )
        # An unusable reading never wins against a usable one: a missing time is the least.
        usable = watched.filter(F.col("latest") & unusable_reason().isNull())
        usable = usable.withColumn("month", F.year("timestamp") * 100 + F.month("timestamp"))
        keys = Observation()
        facts = build_facts(usable, *dimensions.values(), extra=["month"]).observe(
            keys,
            F.min("measurement_id").alias("least"),
            F.max("measurement_id").alias("greatest"),
        )
        # Each task writes a month's facts as one file, in the order they are asked for.
        store.write(FACT_TABLE, step, facts.sortWithinPartitions("month", "time_id", "location_id"))
        _refuse_faults(store, step, documents)
        _replace_older(store, step, keys.get["least"], keys.get["greatest"])
        store.write(HOURLY_TABLE, step, _sums_of(store, step))

        counts = {**flat_counts.get, **clean_counts.get, **seen}
        if counts["unusable"]:
            store.write(REJECT_TABLE, step, _as_rejects(split_unusable(clean)[1]))
        store.publish(step, loads=landings, least=keys.get["least"], greatest=keys.get["greatest"], counts=counts)
        return counts


class StarTarget(Protocol):
    """Star tables that lie elsewhere, see ``sources.jdbc.JdbcStar``."""

    def keys(self, table: str) -> DataFrame:
        """Natural keys and ids of a dimension as stored."""

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to a dimension."""

    def merge_facts(self, facts: DataFrame) -> None:
        """Add facts, replacing those with the same key."""


def load_into(target: StarTarget, documents: DataFrame) -> dict[str, int]:
    """Load documents (with distinct ids) into star tables that lie elsewhere.

    A dimension's rows are settled, with their ids, before any is appended, and
    facts come last. So a load that failed can be repeated: what it has appended
    is found by its natural keys, and facts are merged. Returns the new rows of
    each dimension.
    """
    with scratch():
        clean = clean_measurements(documents)

        def resolve(table: str, extract) -> tuple[DataFrame, int]:
            stored = materialise(target.keys(table), "stored-keys")
            keys, id_column = NATURAL_KEYS[table], ID_COLUMNS[table]
            resolved = materialise(resolve_ids(extract(clean), stored, keys, id_column, new_flag="is_new"), "resolved")
            new = resolved.filter("is_new").drop("is_new")
            target.append(table, new.select(*[f.name for f in STAR[table].fields]))
            return resolved, new.count()

        loaded = for_each_dimension(resolve)
        usable = settled_readings(documents).filter(F.col("latest") & unusable_reason().isNull())
        target.merge_facts(build_facts(usable, *[resolved for resolved, _ in loaded.values()]))
        return {table: new for table, (_, new) in loaded.items()}


def _load_dimension(
    store: StarStore, table: str, rows: DataFrame, step: str
) -> tuple[DataFrame, dict[str, int]]:
    """Resolve ids, write the new rows, return natural keys and ids of the batch, and counts."""
    resolved = resolve_ids(
        rows, store.table(table), NATURAL_KEYS[table], ID_COLUMNS[table], new_flag="is_new"
    )
    found = Observation()
    watched = resolved.observe(found, F.count(F.lit(1)).alias("rows"), F.count_if("is_new").alias("new"))
    store.write(table, step, watched.filter("is_new"))
    if not found.get["new"]:
        store.discard(table, step)
    return resolved, found.get


def _sums_of(store: StarStore, step: str) -> DataFrame:
    """What the step adds to the trend: its facts, once more, by their times."""
    times = store.visible(TIME_TABLE).unionByName(store.read(TIME_TABLE, [step]))
    return hourly_sums(store.read(FACT_TABLE, [step]), times)


def _refuse_faults(store: StarStore, step: str, documents: DataFrame) -> None:
    """Publish the step's faults as rejects and raise, if there are any."""
    faults = materialise(_faults(store, step, documents), "faults")
    found = {row.reject_reason: row["count"] for row in faults.groupBy("reject_reason").count().collect()}
    if found:
        store.write(REJECT_TABLE, f"refused-{step}", faults)
        store.publish(f"refused-{step}", counts={reason: n for reason, n in found.items()})
        raise IntegrityError(f"{step} is not published: {found}")


def _faults(store: StarStore, step: str, documents: DataFrame) -> DataFrame:
    """What would break the star if ``step`` were published: ``raw``, ``reject_reason``, a row a key.

    Natural keys and ids of dimensions must be unique over stored and new rows, and
    ids of the step's facts must be there. Facts need no check by key: a key is
    settled inside its document, and unique natural keys multiply no row, so it is
    enough that the ids of documents are unique, which are far fewer.
    """
    faults = repeated_keys(documents.select(F.col("_id.oid").alias("document_id")), ["document_id"], "repeated document id")
    facts = store.read(FACT_TABLE, [step])
    for table, keys in NATURAL_KEYS.items():
        id_column = ID_COLUMNS[table]
        columns = [*keys, id_column]
        rows = store.visible(table).select(*columns).unionByName(store.read(table, [step]).select(*columns))
        faults = faults.unionByName(repeated_keys(rows, keys, f"repeated natural key in {table}"))
        faults = faults.unionByName(repeated_keys(rows, [id_column], f"repeated id in {table}"))
        missing = dangling_ids(facts, rows, id_column)
        faults = faults.unionByName(
            missing.select(F.to_json(F.struct(id_column)).alias("raw"), F.lit(f"{id_column} does not resolve").alias("reject_reason"))
        )
    return faults


def _replace_older(store: StarStore, step: str, least: str | None, greatest: str | None) -> None:
    """Note which stored facts the step replaces: those with a key it brings again.

    A document lands once and its keys start with its batch, so the key ranges of
    loads are normally apart, and the notes alone tell that nothing is to be done.
    """
    near = store.notes().filter((F.col("least") <= F.lit(greatest)) & (F.col("greatest") >= F.lit(least)))
    steps = [row.step for row in near.select("step").collect()] if least is not None else []
    if steps:
        keys = store.read(FACT_TABLE, [step]).select("measurement_id")
        stored = store.visible(FACT_TABLE).filter(
            F.col("step").isin(steps) & F.col("measurement_id").between(least, greatest)
        )
        replaced = stored.join(keys, "measurement_id", "left_semi")
        store.write(REPLACED_TABLE, step, replaced.select("measurement_id", F.col("step").alias("replaced_step")))


def _as_rejects(unusable: DataFrame) -> DataFrame:
    return unusable.select(F.to_json(F.struct("*")).alias("raw"), "reject_reason")
