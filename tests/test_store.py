import json
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import documents, document, reading, rows_of
from sensormart import operators
from sensormart.plans import IntegrityError, land_documents, load_pending, run_increment, stored_trend, trend_by_hour
from sensormart.schemas import FACT_TABLE, LOCATION_TABLE, MESSAGE, PARAMETER_TABLE, TIME_TABLE
from sensormart.sources import StarStore, read_message_files
from sensormart.sources.store import RAW_TABLE, REJECT_TABLE, REPLACED_TABLE
from sensormart.streaming import start_stream

LATER = "2024-07-01T13:00:00Z"


def _doc(location, *measurements, lat=1.0, lon=2.0):
    fields = ("parameter", "value", "unit", "lastUpdated")
    return {
        "location": location,
        "city": "c",
        "country": "k",
        "coordinates": {"latitude": lat, "longitude": lon},
        "measurements": [dict(zip(fields, m)) for m in measurements],
    }


def _messages(spark, docs):
    lines = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return spark.createDataFrame([(line,) for line in lines], "value string")


def landings(store):
    return sorted(r.step for r in store.notes().filter("lands").collect())


def _natural(store):
    star = store.star()
    joined = (
        star[FACT_TABLE]
        .join(star[LOCATION_TABLE], "location_id", "left")
        .join(star[PARAMETER_TABLE], "parameter_id", "left")
        .join(star[TIME_TABLE], "time_id", "left")
    )
    return rows_of(joined, "latitude", "parameter_name", "timestamp", "value", "unit")


FIRST = [_doc("s", reading("co", 2.0, "ppm"), reading("no2")), _doc("t", reading("co"), lat=5.0), '{"a":']
SECOND = [
    _doc("s", reading("no2")),
    _doc("s", reading("co", 3.0, "ppm", LATER)),
    _doc("u", reading("relativehumidity", 40.0, "%"), lat=0.0),
    _doc("u", reading("relativehumidity", 40.0, "%"), lat=0.0),
    _doc("u", reading("co", at="garbage"), lat=0.0),
]


def test_increments(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    counts = run_increment(store, _messages(spark, FIRST), "b1")
    new = {f"{t}_{n}": c for t, c in ((LOCATION_TABLE, 2), (PARAMETER_TABLE, 2), (TIME_TABLE, 1)) for n in ("rows", "new")}
    assert counts == {"readings": 3, "max_pressure": None, "unusable": 0, **new}
    assert rows_of(operators.unprocessed(store.table(RAW_TABLE)), "location") == []
    assert rows_of(store.table(REJECT_TABLE), "raw", "reject_reason") == [('{"a":', "malformed json")]
    before = {t: rows_of(store.table(t), store.table(t).columns[0]) for t in store.star()}
    assert load_pending(store) == {}

    counts = run_increment(store, _messages(spark, SECOND), "b2")
    assert counts["readings"] == 3 and counts["unusable"] == 1
    assert (counts[f"{PARAMETER_TABLE}_rows"], counts[f"{PARAMETER_TABLE}_new"]) == (2, 1)
    assert store.table(RAW_TABLE).count() == 5
    assert [r[1] for r in rows_of(store.table(REJECT_TABLE), "raw", "reject_reason")].count("malformed time") == 1
    for table, rows in before.items():
        assert set(rows) <= set(rows_of(store.table(table), store.table(table).columns[0]))
    assert operators.integrity_violations(store.star()).filter("violations > 0").isEmpty()
    assert len(_natural(store)) == 5

    everything = _natural(store), rows_of(store.table(FACT_TABLE), "measurement_id")
    assert run_increment(store, _messages(spark, SECOND), "b2") == {}
    assert run_increment(store, _messages(spark, FIRST), "b3") == {}
    assert (_natural(store), rows_of(store.table(FACT_TABLE), "measurement_id")) == everything


def test_split_gives_the_same_star(spark, tmp_path):
    docs = [d for d in FIRST + SECOND if isinstance(d, dict)]
    whole, split = StarStore(spark, str(tmp_path / "a")), StarStore(spark, str(tmp_path / "b"))
    run_increment(whole, _messages(spark, docs), "all")
    for n, doc in enumerate(docs):
        land_documents(split, spark.createDataFrame([json.loads(json.dumps(doc))], MESSAGE), f"d{n}")
    # Two documents hold nothing new: their deliveries leave nothing to load.
    assert split.pending() == [f"land-d{n}" for n in (0, 1, 3, 4, 6)]
    load_pending(split)
    # Within one batch only equal documents are dropped; across batches contained ones too.
    assert set(_natural(split)) == set(_natural(whole))


def test_failed_load_leaves_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch):
    store = StarStore(spark, str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr("sensormart.plans.load.build_facts", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_increment(store, _messages(spark, FIRST), "b1")
    assert all(table.isEmpty() for table in store.star().values())
    assert len(store.pending()) == 1
    run_increment(store, _messages(spark, FIRST), "b1")
    assert len(_natural(store)) == 3 and store.pending() == []


def test_reloaded_keys_replace_stored_facts(spark, tmp_path):
    """A document with a stored id, as a changed copy: its older facts are left out."""
    store = StarStore(spark, str(tmp_path))

    def land(segment, value, oid):
        docs = documents(spark, [document(oid, [reading("co", value)])])
        store.write(RAW_TABLE, segment, operators.content_columns(docs))
        store.publish(segment, lands=True)
        load_pending(store)

    land("l1", 1.0, "a")
    land("l2", 2.0, "b")
    land("l3", 7.0, "a")
    assert rows_of(store.table(FACT_TABLE), "measurement_id", "value") == [("a_co", 7.0), ("b_co", 2.0)]
    replaced = store.visible(REPLACED_TABLE)
    assert rows_of(replaced, "measurement_id", "replaced_step", "step") == [("a_co", "load-l1-l1", "load-l3-l3")]
    assert rows_of(stored_trend(store), "parameter_name", "readings", "avg_value") == [("co", 2, 4.5)]
    land("l4", 8.0, "a")
    assert rows_of(store.table(FACT_TABLE), "measurement_id", "value") == [("a_co", 8.0), ("b_co", 2.0)]


def test_stream_resumes_where_it_ended(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    store = StarStore(spark, str(tmp_path / "store"))

    def deliver(name, docs):
        (source / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
        stream = read_message_files(spark, str(source), max_files=1)
        start_stream(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
        return landings(store)

    first = deliver("1.json", FIRST)
    second = deliver("2.json", SECOND)
    assert len(first) == 1 and len(second) == 2
    stream = read_message_files(spark, str(source))
    start_stream(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert landings(store) == second
    assert len(_natural(store)) == 5


def test_landing_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps(FIRST[0]))
    store = StarStore(spark, str(tmp_path / "store"))
    stream = read_message_files(spark, str(tmp_path / "in"))
    start_stream(stream, store, str(tmp_path / "cp"), land_only=True).awaitTermination()
    assert len(store.pending()) == 1 and store.table(FACT_TABLE).isEmpty()
    load_pending(store)
    assert len(_natural(store)) == 2


def test_streams_with_one_name_do_not_hide_each_other(spark, tmp_path):
    """Two sources with default names, and one of them again after its checkpoint was lost."""
    store = StarStore(spark, str(tmp_path / "store"))
    for folder, docs in (("a", FIRST[:1]), ("b", FIRST[1:2])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "1.json").write_text(json.dumps(docs[0]))
        stream = read_message_files(spark, str(tmp_path / folder))
        start_stream(stream, store, str(tmp_path / f"cp-{folder}")).awaitTermination()
    assert store.table(RAW_TABLE).count() == 2
    (tmp_path / "a" / "2.json").write_text(json.dumps(_doc("w", reading("no2"))))
    stream = read_message_files(spark, str(tmp_path / "a"))
    start_stream(stream, store, str(tmp_path / "cp-new")).awaitTermination()
    assert rows_of(store.table(RAW_TABLE), "location") == [("s",), ("t",), ("w",)]


def test_a_repeated_natural_key_publishes_nothing(spark, tmp_path):
    """Another writer has stored a station's coordinates a second time."""
    store = StarStore(spark, str(tmp_path))
    run_increment(store, _messages(spark, FIRST), "b1")
    before = _natural(store)
    again = store.table(LOCATION_TABLE).filter("location_name = 's'").withColumn("location_id", F.col("location_id") + 100)
    store.write(LOCATION_TABLE, "foreign", again)
    store.publish("foreign")
    for _ in range(2):
        with pytest.raises(IntegrityError, match="repeated natural key in dimension_location"):
            run_increment(store, _messages(spark, SECOND), "b2")
    assert store.table(FACT_TABLE).count() == 3 and store.pending() == ["land-b2"]
    reasons = [r[0] for r in rows_of(store.table(REJECT_TABLE), "reject_reason")]
    assert reasons == ["malformed json", "repeated natural key in dimension_location"]
    # Once the foreign step is gone, the same landing loads.
    shutil.rmtree(tmp_path / "published" / "step=foreign")
    load_pending(store)
    assert len(_natural(store)) == 5 and set(before) <= set(_natural(store)) and store.pending() == []


def test_a_repeated_document_id_publishes_nothing(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    docs = documents(spark, [document("a", [reading("co")]), document("a", [reading("no2")])])
    store.write(RAW_TABLE, "l1", operators.content_columns(docs))
    store.publish("l1", lands=True)
    with pytest.raises(IntegrityError):
        load_pending(store)
    assert rows_of(store.table(REJECT_TABLE), "raw") == [('{"document_id":"a"}',)] and store.table(FACT_TABLE).isEmpty()


def test_steps_count_what_they_saw_and_leave_no_scratch(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    scratch = Path(spark.conf.get("spark.checkpoint.dir"), "sensormart", spark.conf.get("spark.app.id"))
    before = set(scratch.iterdir()) if scratch.exists() else set()
    run_increment(store, _messages(spark, FIRST), "b1")
    run_increment(store, _messages(spark, []), "b2")
    assert set(scratch.iterdir()) == before
    counts = {(r.step, r.name): r.value for r in store.counts().collect()}
    assert counts["land-b1", "messages"] == 3 and counts["land-b1", "rejects"] == 1 and counts["land-b1", "new"] == 2
    assert counts["load-land-b1-land-b1", "readings"] == 3 and counts["land-b2", "messages"] == 0
    assert store.pending() == [] and len({s for s, _ in counts}) == 3


def test_facts_of_a_month_are_read_alone(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    times = ["2024-07-01T12:00:00Z", "2024-07-31T23:00:00Z", "2024-08-02T00:00:00Z", "2023-07-05T00:00:00Z"]
    run_increment(store, _messages(spark, [_doc("s", *[reading(f"p{i}", float(i), at=t) for i, t in enumerate(times)])]), "b1")
    star = store.star()
    trend = trend_by_hour(star, months=[(2024, 8), (2023, 7)])
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ IN \(202408,202307\)", plan), re.findall("PartitionFilters.{90}", plan)
    # Local time: the last of July, 23:00 UTC, is the first of August in the local zone.
    assert rows_of(trend, "parameter_name", "month", "day") == [("p1", 8, 1), ("p2", 8, 2), ("p3", 7, 5)]
    assert trend_by_hour(star).count() == 4


def test_the_trend_is_kept_with_each_load(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    values = [0.1, 0.2, 0.3, 1e15, -1e15]
    for n in range(2):
        run_increment(store, _messages(spark, [_doc(f"s{n}{i}", reading("co", v)) for i, v in enumerate(values)]), f"b{n}")
    trend = stored_trend(store)
    assert FACT_TABLE not in " ".join(trend.inputFiles())
    assert trend.collect() == trend_by_hour(store.star()).collect()
    assert trend.first().readings == 10 and trend.first().avg_value == pytest.approx(0.12, abs=1e-3)
    assert stored_trend(store, months=[(2023, 1)]).isEmpty() and stored_trend(store, months=[(2024, 7)]).count() == 1


def test_increments_stay_alike(spark, tmp_path):
    """A later increment writes as many files as an earlier one."""
    store, written = StarStore(spark, str(tmp_path)), []
    for n in range(6):
        run_increment(store, _messages(spark, [_doc("s", reading("co", float(n)))]), f"b{n}")
        written.append(sum(1 for _ in tmp_path.rglob("*.parquet")))
    steps = [b - a for a, b in zip(written, written[1:])]
    assert len(set(steps)) == 1


def test_equal_documents_without_readings_stay(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    empty = [_doc("s"), _doc("s")]
    run_increment(store, _messages(spark, empty), "b1")
    run_increment(store, _messages(spark, empty[:1]), "b2")
    raw = store.table(RAW_TABLE)
    assert raw.count() == 3 and raw.select("_id.oid").distinct().count() == 3


def test_dimension_without_new_rows_gets_no_folder(spark, tmp_path):
    store = StarStore(spark, str(tmp_path))
    for n in range(3):
        run_increment(store, _messages(spark, [_doc("s", reading("co", float(n)))]), f"b{n}")
    written = {t: len(list((tmp_path / t).glob("step=*"))) for t in (PARAMETER_TABLE, FACT_TABLE)}
    assert written == {PARAMETER_TABLE: 1, FACT_TABLE: 3}


def test_documents_move_once_to_meet_what_is_new(spark, tmp_path, monkeypatch):
    """Repeats in the batch and in the history are settled by addresses, in one join with the documents."""
    store, plans, write = StarStore(spark, str(tmp_path)), [], StarStore.write

    def watched(self, table, step, rows):
        if table == RAW_TABLE:
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(self, table, step, rows)

    monkeypatch.setattr(StarStore, "write", watched)
    a, b = document("a", [reading("co")]), document("b", [reading("no2")])
    for batch, docs in (("1", [a, a]), ("2", [a, b, b])):
        land_documents(store, documents(spark, docs), batch)
    assert [plan.count("Join ") for plan in plans] == [1, 1]
    assert store.table(RAW_TABLE).count() == 2
