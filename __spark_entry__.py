
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles  # noqa: E402
from sensormart import fixtures, functions, operators
from sensormart.plans import (
    DIMENSIONS,
    IntegrityError,
    for_each_dimension,
    fresh_star,
    run_increment,
    stored_trend,
    trend_by_hour,
)
from sensormart.schemas import (
    FACT_TABLE,
    ID_COLUMNS,
    LOCATION_TABLE,
    NATURAL_KEYS,
    PARAMETER_TABLE,
    TIME_TABLE,
)
from sensormart.session import materialise, scratch_path
from sensormart.sources import (
    StarStore,
    decode_messages,
    encode_messages,
    has_geo,
    read_documents,
    read_message_files,
    read_pages,
    unnest_results,
)
from sensormart.sources.store import RAW_TABLE, REJECT_TABLE
from sensormart.streaming import start_stream

try:
    import corpus_pipeline
    from sensormart.llm import queries as llm
except ImportError:
    llm = None


# -- sources -----------------------------------------------------------------
def raw_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response pages (one document each) landed as JSON, read back and unnested."""
    path = scratch_path(spark, "pages")
    docs = fixtures.documents(spark, sf_dir)
    docs.select(F.array(F.struct("*")).alias("results")).write.json(path)
    landed = has_geo(unnest_results(read_pages(spark, path, one_per_line=True)))
    return _flat(landed, F.col("_id.oid").alias("doc_id"))


def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> JSON messages -> documents."""
    good, _ = decode_messages(encode_messages(fixtures.documents(spark, sf_dir)))
    return _flat(good)


def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is put aside, by region: messages cut short, without a station, with a bad reading.

    Where the first reading's value is no number, only that reading is lost; a
    document that has no other goes as a whole. ``readings``: of the documents kept, else 0.
    """
    docs = fixtures.documents(spark, sf_dir)
    nameless = docs.withColumn("location", F.when(F.col("country") != "EUROPE", F.col("location")))
    text = F.col("value").cast("string")
    cut = F.when(text.contains('"country":"ASIA"'), text.substr(F.lit(1), F.length(text) - 2))
    typed = F.regexp_replace(text, r'^(.*?"value":)[^,]*', '$1"n/a"')
    bad = F.when(text.contains('"country":"AFRICA"'), typed)
    good, rejects = decode_messages(
        encode_messages(nameless).select(F.coalesce(cut, bad, text).cast("binary").alias("value"))
    )
    kept = good.select(F.lit("accepted").alias("reject_reason"), F.size("measurements").alias("n"))
    return (
        rejects.select("reject_reason", F.lit(None).cast("int").alias("n"))
        .unionByName(kept)
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("messages"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("readings"))
    )


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a document store keeps them, read with their fixed schema."""
    path = scratch_path(spark, "documents")
    fixtures.documents(spark, sf_dir).write.parquet(path)
    return _flat(read_documents(spark, path), F.col("_id.oid").alias("doc_id"))


def _flat(docs: DataFrame, *extra) -> DataFrame:
    return docs.withColumn("m", F.explode("measurements")).select(
        *extra,
        "location",
        "city",
        "country",
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.col("m.parameter").alias("parameter"),
        F.col("m.value").alias("value"),
        F.col("m.unit").alias("unit"),
        F.col("m.lastUpdated").alias("last_updated"),
    )


def latest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of the newest documents."""
    page = operators.latest_page(fixtures.documents(spark, sf_dir), page=2)
    return page.select(
        F.col("_id.oid").alias("doc_id"), "location", F.size("measurements").alias("readings")
    )


def page_by_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourth page of the newest documents, each page from the end of the one before."""
    docs = materialise(operators.with_newest(fixtures.documents(spark, sf_dir)), "by-newest")
    cursor = None
    for _ in range(3):
        cursor = operators.cursor_of(operators.page_after(docs, cursor)) or cursor
    page = operators.page_after(docs, cursor)
    return page.select(
        F.col("_id.oid").alias("doc_id"), "location", F.size("measurements").alias("readings")
    )


# -- processing state --------------------------------------------------------
def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents flagged by region: AFRICA done, ASIA without a flag, others open."""
    flag = F.when(F.col("country") == "AFRICA", True).when(F.col("country") != "ASIA", False)
    return fixtures.documents(spark, sf_dir).withColumn("processed", flag)


def unprocessed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per region under each reading of the flag."""
    docs = _flagged(spark, sf_dir)
    views = {
        "unprocessed": operators.unprocessed(docs),
        "processed": operators.processed(docs),
        "not marked": operators.not_marked(docs),
        "unprocessed after backfill": operators.unprocessed(operators.backfill_processed(docs)),
    }
    return _counted(views)


def mark_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mark what was read as unprocessed, and nothing else."""
    docs = _flagged(spark, sf_dir)
    marked = operators.mark_processed(docs, operators.unprocessed(docs))
    return _counted({"processed": operators.processed(marked)})


def _counted(views: dict[str, DataFrame]) -> DataFrame:
    result = None
    for name, docs in views.items():
        part = docs.groupBy("country").agg(F.count(F.lit(1)).alias("documents"))
        part = part.select(F.lit(name).alias("view_name"), "country", "documents")
        result = part if result is None else result.unionByName(part)
    return result


# -- cleaning ----------------------------------------------------------------
def measurement_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    flattened = operators.flatten_measurements(fixtures.documents(spark, sf_dir))
    return flattened.select("measurement_id", "parameter_name", "last_updated")


def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units(fixtures.flattened(spark, sf_dir), strict=False)


def unit_conversion_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _units(fixtures.flattened(spark, sf_dir), strict=True)


def _units(readings: DataFrame, strict: bool) -> DataFrame:
    columns = ["measurement_id", "last_updated", "parameter_name", "value", "unit"]
    return operators.harmonise_units(readings, strict).select(*columns)


def paris_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = functions.epoch_seconds(F.col("last_updated"))
    local = functions.local_wall_clock(seconds)
    return fixtures.flattened(spark, sf_dir).select(
        "measurement_id",
        "last_updated",
        local.alias("local_time"),
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_text"),
    )


def zoned_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local times as texts with their offset; the clock reading alone as if it were UTC."""
    local = functions.local_wall_clock(functions.epoch_seconds(F.col("last_updated")))
    return fixtures.flattened(spark, sf_dir).select(
        "measurement_id",
        "last_updated",
        functions.zoned_text(local, functions.LOCAL_ZONE).alias("with_offset"),
        functions.zoned_text(local, "UTC").alias("as_utc"),
    )


def pressure_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = operators.harmonise_units(fixtures.flattened(spark, sf_dir))
    clamped = operators.clamp_pressure(converted)
    return clamped.select("measurement_id", "last_updated", "parameter_name", "value")


def pressure_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correction on one reading per key, held against a self-join in SQL."""
    converted = operators.harmonise_units(fixtures.flattened(spark, sf_dir))
    latest = operators.latest_per_key(converted, order=["last_updated", "value", "unit"])
    clamped = operators.clamp_pressure(latest)
    return clamped.select("measurement_id", "parameter_name", "value", "unit")


def pressure_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.max_pressure(fixtures.flattened(spark, sf_dir))


def clean_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.clean_measurements(fixtures.documents(spark, sf_dir))


# -- dimensions --------------------------------------------------------------
def _fresh(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = DIMENSIONS[table](fixtures.clean(spark, sf_dir))
        return operators.number_rows(rows, NATURAL_KEYS[table], ID_COLUMNS[table])

    return query


def _resolved(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _resolve(fixtures.clean(spark, sf_dir), table)

    return query


def _resolve(clean: DataFrame, table: str) -> DataFrame:
    existing = fixtures.preloaded_dimension(clean, table)
    return operators.resolve_ids(DIMENSIONS[table](clean), existing, NATURAL_KEYS[table], ID_COLUMNS[table])


def _new_rows(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        clean = fixtures.clean(spark, sf_dir)
        existing = fixtures.preloaded_dimension(clean, table)
        keys = NATURAL_KEYS[table]
        resolved = operators.resolve_ids(DIMENSIONS[table](clean), existing, keys, ID_COLUMNS[table])
        return operators.new_dimension_rows(resolved, existing, keys)

    return query


# -- facts -------------------------------------------------------------------
def fact_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading, repeated keys included, with ids resolved against stored dimensions."""
    clean = fixtures.clean(spark, sf_dir)
    resolved = for_each_dimension(lambda table, extract: _resolve(clean, table))
    return operators.build_facts(clean, *resolved.values())


def first_per_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = operators.first_per_reading(fixtures.clean(spark, sf_dir))
    return first.select("measurement_id", "parameter_name", "timestamp", "value", "unit")


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts (all but humidity) merged with a batch that corrects every pressure

    reading and brings humidity.
    """
    facts = fresh_star(fixtures.landed(spark, sf_dir))[FACT_TABLE]
    lower = F.lower(F.element_at(F.split("measurement_id", "_"), -1))
    target = facts.filter(lower != "relativehumidity")
    source = facts.filter(lower.isin("relativehumidity", "pressure")).withColumn(
        "value", F.col("value") + 1
    )
    return operators.upsert_facts(target, source)


def integrity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules on a star with faults: a station twice, midnight hours missing from time."""
    star = fresh_star(fixtures.landed(spark, sf_dir))
    location = star[LOCATION_TABLE]
    star[LOCATION_TABLE] = location.unionByName(location.filter("country = 'ASIA'"))
    star[TIME_TABLE] = star[TIME_TABLE].filter("hour <> 0")
    return operators.integrity_violations(star)


def trend_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend_by_hour(fresh_star(fixtures.landed(spark, sf_dir)))


def trend_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend from what two loads have added to it, without reading a fact."""
    store = StarStore(spark, scratch_path(spark, "trend"))
    docs = fixtures.landed(spark, sf_dir)
    early = F.col("country").isin("AFRICA", "AMERICA", "ASIA")
    for number, delivery in enumerate((docs.filter(early), docs.filter(~early)), 1):
        run_increment(store, encode_messages(delivery), f"d{number}")
    return stored_trend(store)


# -- ingest ------------------------------------------------------------------
def containment_new_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, stored = fixtures.history_and_redelivery(spark, sf_dir)
    # As in the store: the history is kept with its content columns.
    stored = materialise(operators.content_columns(stored), "stored")
    new = operators.drop_contained(incoming, stored)
    return new.select(F.col("_id.oid").alias("doc_id"), F.size("measurements").alias("readings"))


def batch_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document twice, the second time with its readings in another order."""
    docs = fixtures.documents(spark, sf_dir)
    again = docs.withColumn("_id", F.struct(F.concat("_id.oid", F.lit("-again")).alias("oid")))
    again = again.withColumn("measurements", F.reverse("measurements"))
    kept = operators.drop_repeats(docs.unionByName(again))
    return kept.select(F.col("_id.oid").alias("doc_id"), F.size("measurements").alias("readings"))


def normalised_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = operators.normalise_measurements(fixtures.documents(spark, sf_dir))
    return docs.select(
        F.col("_id.oid").alias("doc_id"), F.posexplode("measurements").alias("position", "m")
    ).select("doc_id", "position", "m.parameter", "m.value", "m.unit")


def stream_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries through the stream: some regions first, then everything again.

    Facts are shown by natural keys; ids depend on the order of arrival.
    """
    root = scratch_path(spark, "stream")
    docs = fixtures.documents(spark, sf_dir)
    store = StarStore(spark, f"{root}/store")
    for delivery in (docs.filter(F.col("country").isin("AFRICA", "AMERICA", "ASIA")), docs):
        messages = encode_messages(delivery).select(F.col("value").cast("string"))
        messages.write.mode("append").text(f"{root}/messages")
        stream = read_message_files(spark, f"{root}/messages")
        start_stream(stream, store, f"{root}/checkpoint").awaitTermination()
    star = store.star()
    return (
        star[FACT_TABLE]
        .join(star[LOCATION_TABLE], "location_id")
        .join(star[PARAMETER_TABLE], "parameter_id")
        .join(star[TIME_TABLE], "time_id")
        .select("latitude", "longitude", "parameter_name", "timestamp", "value", "unit")
    )


def bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six files of messages, one a micro-batch. A run fails after a micro-batch has landed

    and before Spark has noted it; the next run takes it again and goes on. Each
    document lands once.
    """
    root = scratch_path(spark, "bounded")
    messages = encode_messages(fixtures.documents(spark, sf_dir)).select(F.col("value").cast("string"))
    messages.repartition(6).write.text(f"{root}/messages")
    store = StarStore(spark, f"{root}/store")
    landed = []

    def fail_once(label: str) -> None:
        landed.append(label)
        if len(landed) == 3:
            raise RuntimeError("stopped before the micro-batch is noted")

    for attempt in range(2):
        stream = read_message_files(spark, f"{root}/messages", max_files=1)
        run = start_stream(stream, store, f"{root}/checkpoint", land_only=True, after=fail_once)
        try:
            run.awaitTermination()
        except StreamingQueryException:
            if attempt:
                raise
    return store.table(RAW_TABLE).select(
        "location", "country", F.size("measurements").alias("readings"), "last_updated"
    )


def step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two deliveries and an empty one have counted, step by step."""
    store = StarStore(spark, scratch_path(spark, "counts"))
    docs = materialise(fixtures.documents(spark, sf_dir), "documents")
    first = docs.filter(F.col("country").isin("AFRICA", "AMERICA", "ASIA"))
    for number, delivery in enumerate((first, docs, docs.filter("country = 'nowhere'")), 1):
        run_increment(store, encode_messages(delivery), f"d{number}")
    return store.counts().select("step", "name", "value")


def load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that would break the star: another writer has stored some stations a second time.

    The second load is refused: its facts do not appear, its landing stays pending,
    and the repeated keys are among the rejects.
    """
    store = StarStore(spark, scratch_path(spark, "gate"))
    docs = materialise(fixtures.documents(spark, sf_dir), "documents")
    early = F.col("country").isin("AFRICA", "AMERICA")
    run_increment(store, encode_messages(docs.filter(early)), "d1")
    stations = store.table(LOCATION_TABLE).filter("country = 'AFRICA'")
    store.write(LOCATION_TABLE, "foreign", stations.withColumn("location_id", F.col("location_id") + 1_000_000))
    store.publish("foreign")
    try:
        run_increment(store, encode_messages(docs.filter(~early)), "d2")
    except IntegrityError:
        pass
    else:
        raise AssertionError("the load was not refused")
    pending = len(store.pending())
    return (
        store.table(REJECT_TABLE)
        .groupBy(F.col("reject_reason").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .unionByName(store.table(FACT_TABLE).agg(F.lit("facts").alias("name"), F.count(F.lit(1)).alias("n")))
        .unionByName(spark.range(1).select(F.lit("pending landings").alias("name"), F.lit(pending).cast("long").alias("n")))
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly trend per parameter, from raw documents through the star schema."""
    return trend_query(spark, "/root/testdata/sf0.001")


def star_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "raw_unnest": raw_unnest,
        "message_round_trip": message_round_trip,
        "message_rejects": message_rejects,
        "stored_documents": stored_documents,
        "latest_page": latest_page,
        "page_by_cursor": page_by_cursor,
        "unprocessed_filter": unprocessed_filter,
        "mark_processed": mark_processed,
        "measurement_key": measurement_key,
        "unit_conversion": unit_conversion,
        "unit_conversion_strict": unit_conversion_strict,
        "paris_time": paris_time,
        "zoned_time": zoned_time,
        "pressure_clamp": pressure_clamp,
        "pressure_left_join": pressure_left_join,
        "pressure_max": pressure_max,
        "clean_measurements": clean_measurements,
        "dim_location": _fresh(LOCATION_TABLE),
        "dim_parameter": _fresh(PARAMETER_TABLE),
        "dim_time": _fresh(TIME_TABLE),
        "dim_resolve_location_ids": _resolved(LOCATION_TABLE),
        "dim_resolve_parameter_ids": _resolved(PARAMETER_TABLE),
        "dim_resolve_time_ids": _resolved(TIME_TABLE),
        "dim_new_locations": _new_rows(LOCATION_TABLE),
        "dim_new_parameters": _new_rows(PARAMETER_TABLE),
        "dim_new_times": _new_rows(TIME_TABLE),
        "fact_star_join": fact_star_join,
        "first_per_reading": first_per_reading,
        "fact_upsert": fact_upsert,
        "integrity_violations": integrity_violations,
        "trend_by_hour": trend_query,
        "trend_maintained": trend_maintained,
        "containment_new_docs": containment_new_docs,
        "batch_repeats": batch_repeats,
        "normalised_documents": normalised_documents,
        "stream_increment": stream_increment,
        "bounded_stream": bounded_stream,
        "step_counts": step_counts,
        "load_gate": load_gate,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = star_queries()
    if llm is not None:
        registered |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return registered


def oracle_sql() -> dict[str, str]:
    texts = oracles.all_queries()
    if llm is not None:
        texts |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            texts["pipeline"] = corpus_pipeline.ORACLE_SQL
    return texts
