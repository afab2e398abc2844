"""Message streams: one document per message, JSON in UTF-8, no key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sensormart.schemas import COORDINATES, MEASUREMENT, MESSAGE

TOPIC = "air_quality"  # fixed value

BAD_READING = "badly typed reading"

_CORRUPT = "_corrupt"
_PARSED = StructType([*MESSAGE.fields, StructField(_CORRUPT, StringType(), True)])


def encode_messages(docs: DataFrame) -> DataFrame:
    """Documents -> ``value`` (binary JSON), the frame a Kafka sink takes."""
    fields = F.struct(*[f.name for f in MESSAGE.fields])
    return docs.select(
        F.to_json(fields, {"ignoreNullFields": "false"}).cast("binary").alias("value")
    )


def _given(value: Column) -> Column:
    """Whether a variant is there and no JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def _number(value: Column) -> Column:
    """A variant's number, by its text, so that no digit is lost; NULL if it is none."""
    return F.try_variant_get(value, "$", "string").try_cast("double")


def _read_one(reading: Column) -> Column:
    """(reading, its text if it is badly typed) of a variant.

    A reading is an object whose value is a number, a number's text or null.
    """
    value = F.try_variant_get(reading, "$.value", "variant")
    bad = ~F.schema_of_variant(reading).startswith("OBJECT") | (_given(value) & _number(value).isNull())
    fields = [
        (_number(value) if f.name == "value" else F.try_variant_get(reading, f"$.{f.name}", "string")).alias(f.name)
        for f in MEASUREMENT.fields
    ]
    missing = F.lit(None).cast(MEASUREMENT)
    return F.struct(
        F.when(F.is_variant_null(reading) | bad, missing).otherwise(F.struct(*fields)).alias("reading"),
        F.when(bad & ~F.is_variant_null(reading), F.to_json(reading)).alias("bad"),
    )


def _settled(rows: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` of ``rows``, each computed once a row.

    A filter or projection takes over the expressions of the projection below it, once for
    every use, which multiplies from step to step. A generated row keeps them apart.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select(F.explode_outer(F.array(row)).alias("_row")).select("_row.*")


def _salvaged(parsed: DataFrame) -> DataFrame:
    """Add to ``raw``, ``doc``, ``broken`` what is in texts that do not fit the schema as a whole.

    ``saved`` is the document, ``kept`` its readings, ``bad`` the texts of those that are
    badly typed. ``kept`` is NULL where the text is no JSON object, or its coordinates or
    measurements are of another kind: such a text is lost as a whole.
    """
    known = {c: F.col(c) for c in ("raw", "doc", "broken")}
    parsed = _settled(parsed, **known, tree=F.when(F.col("broken"), F.try_parse_json("raw")))
    tree = F.col("tree")
    parsed = _settled(
        parsed,
        **known,
        whole=F.schema_of_variant(tree).startswith("OBJECT"),
        place=F.try_variant_get(tree, "$.coordinates", "variant"),
        list_of=F.try_variant_get(tree, "$.measurements", "variant"),
        **{f: F.try_variant_get(tree, f"$.{f}", "string") for f in ("location", "city", "country")},
    )
    place, list_of = F.col("place"), F.col("list_of")
    parts = [F.try_variant_get(place, f"$.{f.name}", "variant") for f in COORDINATES.fields]
    fits = F.col("whole") & (~_given(place) | F.schema_of_variant(place).startswith("OBJECT"))
    for part in parts:
        fits = fits & (~_given(part) | _number(part).isNotNull())
    fits = fits & _given(list_of)
    readings = F.transform(F.try_variant_get(list_of, "$", "array<variant>"), _read_one)
    numbers = [_number(part).alias(f.name) for part, f in zip(parts, COORDINATES.fields)]
    coordinates = F.when(_given(place), F.struct(*numbers)).alias("coordinates")
    saved = F.struct("location", "city", "country", coordinates)
    parsed = _settled(parsed, **known, saved=saved, readings=F.when(F.col("broken") & fits, readings))
    return _settled(
        parsed,
        **known,
        saved=F.col("saved"),
        kept=F.transform(F.filter("readings", lambda r: r["bad"].isNull()), lambda r: r["reading"]),
        bad=F.filter(F.transform("readings", lambda r: r["bad"]), lambda text: text.isNotNull()),
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Decode ``value``; ``reject_reason`` is NULL for good documents.

    A document must have every field of a message; a null is a value, except for
    the station's name and the measurements. The raw text is kept for rejects only.

    A text that does not fit the schema as a whole is read once more as a variant:
    its badly typed readings go to ``bad_readings``, as text, and the others make up
    the document. If none is left, the whole document is put aside.
    """
    parsed = _settled(messages, raw=F.col("value").cast("string"))
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = _settled(parsed, raw=F.col("raw"), doc=F.from_json("raw", _PARSED, options))
    broken = F.col("doc").isNull() | F.col(f"doc.{_CORRUPT}").isNotNull()
    parsed = _salvaged(parsed.withColumn("broken", broken))
    broken = F.col("broken")
    usable = broken & F.col("kept").isNotNull() & ((F.size("kept") > 0) | (F.size("bad") == 0))
    saved = {f: F.col(f"saved.{f}") for f in ("location", "city", "country", "coordinates")} | {"measurements": F.col("kept")}
    fields = {f.name: F.when(broken, F.when(usable, saved[f.name])).otherwise(F.col(f"doc.{f.name}")) for f in MESSAGE.fields}
    needed = F.array(*[F.lit(f.name) for f in MESSAGE.fields])
    # A field that is there with a value need not be sought; only then is the text not read again.
    given = F.lit(True)
    for f in MESSAGE.fields:
        given = given & fields[f.name].isNotNull()
    missing = F.when(~given, F.get(F.array_except(needed, F.json_object_keys("raw")), 0))
    whole = F.when(broken & ~F.coalesce(usable, F.lit(False)), F.when(F.size("bad") > 0, "badly typed readings").otherwise("malformed json"))
    judged = _settled(parsed, raw=F.col("raw"), _bad=F.col("bad"), _missing=missing, _whole=whole, **fields)
    reason = (
        F.when(F.col("_whole").isNotNull(), F.col("_whole"))
        .when(F.col("_missing").isNotNull(), F.concat(F.lit("missing "), F.col("_missing")))
        .when(F.col("location").isNull(), "missing location")
        .when(F.col("measurements").isNull(), "missing measurements")
    )
    none = F.lit(None).cast("array<string>")
    return judged.withColumn("reject_reason", reason).select(
        *[f.name for f in MESSAGE.fields],
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("raw")).alias("raw"),
        F.when(F.col("reject_reason").isNull(), F.when(F.size("_bad") > 0, F.col("_bad"))).otherwise(none).alias("bad_readings"),
    )


def rejects_of(parsed: DataFrame) -> DataFrame:
    """``raw`` and ``reject_reason`` of what ``parse_messages`` put aside: whole messages, single readings."""
    whole = F.array(F.struct("raw", "reject_reason"))
    readings = F.transform("bad_readings", lambda text: F.struct(text.alias("raw"), F.lit(BAD_READING).alias("reject_reason")))
    found = F.when(F.col("reject_reason").isNotNull(), whole).otherwise(readings)
    return parsed.select(F.explode(found).alias("_reject")).select("_reject.*")


def decode_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects with their text and reason)."""
    parsed = parse_messages(messages)
    good = parsed.filter("reject_reason IS NULL").select(*[f.name for f in MESSAGE.fields])
    return good, rejects_of(parsed)


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed message files, one JSON document per line."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_source_options(
    servers: str, topic: str = TOPIC, per_trigger: int | None = None, **options: str
) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``: from the earliest message on.

    The query's checkpoint holds the offsets that a consumer group would hold.
    ``per_trigger`` bounds a micro-batch; with ``availableNow`` a run still takes
    everything that has arrived. ``options`` adds others (security, offsets, rates)
    or replaces these.
    """
    known = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if per_trigger is not None:
        known["maxOffsetsPerTrigger"] = str(per_trigger)
    return known | options


def kafka_sink_options(servers: str, topic: str = TOPIC, **options: str) -> dict[str, str]:
    """Options for ``encode_messages(docs).write.format("kafka")``; ``options`` adds others."""
    return {"kafka.bootstrap.servers": servers, "topic": topic} | options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of a Kafka topic. The Kafka connector must be on the class path."""
    found = kafka_source_options(servers, topic, per_trigger, **options)
    return spark.readStream.format("kafka").options(**found).load()


def write_topic(docs: DataFrame, servers: str, topic: str = TOPIC, **options: str) -> None:
    """Send documents to a Kafka topic, one message each."""
    found = kafka_sink_options(servers, topic, **options)
    encode_messages(docs).write.format("kafka").options(**found).save()
