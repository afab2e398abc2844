import random
import re

import pytest

from helpers import document, documents, reading, rows_of
from sensormart.operators import containment, content_columns, drop_contained
from sensormart.operators.containment import nearby_history
from sensormart.session import materialise


def _brute(incoming, stored):
    """Ids of the incoming documents no stored one contains."""
    new = []
    for (oid,), *station, measurements, _ in incoming:
        wanted = set(measurements or [])
        inside = any(station == list(s[1:5]) and wanted <= set(s[5] or []) for s in stored)
        if not wanted or not inside:
            new.append((oid,))
    return sorted(new)


def _check(spark, incoming, stored):
    got = drop_contained(documents(spark, incoming), documents(spark, stored))
    assert rows_of(got, "_id.oid") == _brute(incoming, stored)


def test_rules(spark):
    a, b, c = reading("a"), reading("b"), reading("c")
    stored = [
        document("s1", [a, b, c]),
        document("s2", [a], location="other"),
        document("s3", [a, c], city=None),
        document("s4", []),
    ]
    incoming = [
        document("equal", [c, b, a]),
        document("subset", [a, b]),
        document("one", [b]),
        document("repeated reading", [b, b]),
        document("superset", [a, b, c, reading("d")]),
        document("other station", [b], location="other"),
        document("other value", [reading("a", 2.0)]),
        document("other unit", [reading("a", unit="x")]),
        document("other time", [reading("a", at="2024-07-01T12:00:01+00:00")]),
        document("city missing", [c], city=None),
        document("city given", [c], city="x"),
        document("empty", []),
        document("null", None),
    ]
    _check(spark, incoming, stored)


def test_pieces_of_two_documents_are_not_one(spark):
    a, b, c, d = (reading(p) for p in "abcd")
    _check(spark, [document("n", [a, b, c])], [document("s", [a, b, d]), document("t", [b, c, d]), document("u", [a, c, d])])


def test_null_fields_match(spark):
    odd = reading("a", None, None, None)
    _check(spark, [document("n", [odd, reading("b")], at=(None, 2.0))], [document("s", [odd, reading("b"), reading("c")], at=(None, 2.0))])


def test_empty_history(spark):
    _check(spark, [document("n", [reading()])], [])


@pytest.mark.parametrize("seed", [1, 2])
def test_random_sets_with_a_hot_station(spark, seed):
    """Two thirds of the documents at one station; one reading is in nearly all of them."""
    rng = random.Random(seed)

    def some(oid):
        location = "hot" if rng.random() < 0.67 else f"s{rng.randrange(4)}"
        m = [reading(f"p{rng.randrange(9)}", float(rng.randrange(2))) for _ in range(rng.randrange(7))]
        if rng.random() < 0.9:
            m.append(reading("stale"))
        return document(oid, m, location=location)

    stored = [some(f"s{i}") for i in range(400)]
    incoming = [some(f"n{i}") for i in range(300)]
    _check(spark, incoming, stored)


def test_many_holders_of_one_pivot(spark):
    """More holders than one word has bits, and only the last holds everything."""
    a, b = reading("a"), reading("b")
    stored = [document(f"s{i:03}", [a, reading(f"x{i}")]) for i in range(200)]
    stored += [document(f"t{i:03}", [b, reading(f"x{i}")]) for i in range(200)]
    _check(spark, [document("n", [a, b])], stored)
    _check(spark, [document("n", [a, b])], [*stored, document("z", [a, b, reading("c")])])


def _subsets(rng, prefix, n, universe, least, most):
    return [
        document(f"{prefix}{i}", [reading(f"p{x}") for x in rng.sample(range(universe), rng.randint(least, most))])
        for i in range(n)
    ]


@pytest.mark.parametrize("direct,single", [(64, 8), (1, 8), (1, 1)])
def test_sets_of_common_readings(spark, monkeypatch, direct, single):
    """All readings are common, sets are large or small, nothing can be told by one reading."""
    monkeypatch.setattr(containment, "DIRECT", direct)
    monkeypatch.setattr(containment, "SINGLE_STEPS", single)
    rng = random.Random(11)
    stored = _subsets(rng, "s", 150, 12, 4, 9) + _subsets(rng, "t", 10, 12, 11, 12)
    incoming = _subsets(rng, "n", 120, 12, 2, 8) + _subsets(rng, "m", 20, 12, 9, 12)
    _check(spark, incoming, stored)


def _common(rng, prefix, n):
    """Nearly all of a station's 40 readings in each document, and often one of its own kind."""
    rows = []
    for i in range(n):
        m = [reading(f"p{x}") for x in rng.sample(range(40), rng.randint(36, 40))]
        if rng.random() < 0.7:
            m.append(reading(f"own{rng.randrange(n)}"))
        rows.append(document(f"{prefix}{i}", m))
    return rows


def _halves(rng, prefix, n):
    return _subsets(rng, prefix, n, 40, 20, 20)


@pytest.mark.parametrize("make,most", [(_common, 5), (_halves, 7)])
def test_rows_grow_with_the_documents_not_with_their_pairs(spark, monkeypatch, make, most):
    """One station, 40 readings that are all common, four times the documents: sixteen times the pairs."""
    written = []

    def counting(df, name, *args):
        copy = materialise(df, name, *args)
        written.append(copy.count())
        return copy

    monkeypatch.setattr(containment, "materialise", counting)
    rows = []
    for n in (250, 1000):
        rng = random.Random(5)
        written.clear()
        stored, incoming = make(rng, "s", n), make(rng, "n", n)
        _check(spark, incoming, stored)
        rows.append(sum(written))
    assert rows[1] <= most * rows[0]


def test_a_batch_of_one_station_reads_one_bucket(spark, tmp_path):
    rng = random.Random(3)
    many = [document(f"s{i}", [reading(f"p{rng.randrange(5)}")], location=f"station {i}") for i in range(200)]
    path = str(tmp_path / "history")
    content_columns(documents(spark, many)).write.partitionBy("bucket").parquet(path)
    stored = spark.read.parquet(path)
    sets = content_columns(documents(spark, many[:1]))
    history = nearby_history(stored, sets)
    bucket = sets.first().bucket
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {bucket}\)?[,\]]", plan), plan
    assert {r.location for r in history.collect()} == {"station 0"}


def test_no_pairing_joins(spark):
    incoming = documents(spark, [document("n", [reading("a"), reading("b")])])
    stored = documents(spark, [document("s", [reading("a"), reading("b"), reading("c")])])
    plan = drop_contained(incoming, stored)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_readings_of_the_batch_leave_the_history(spark, monkeypatch):
    """A history of many other readings at the batch's station: next to nothing of it is written."""
    written = {}

    def counting(df, name, *args):
        copy = materialise(df, name, *args)
        written[name] = copy.count()
        return copy

    monkeypatch.setattr(containment, "materialise", counting)
    stored = [document(f"s{i}", [reading(f"p{i}"), reading(f"q{i}")]) for i in range(2000)]
    _check(spark, [document("n", [reading("p7")]), document("m", [reading("p8"), reading("q9")])], stored)
    assert written["held"] < 100


def test_a_missing_field_is_no_other_field(spark):
    """Hashes of readings tell a null from a field that moved up, and take both zeros as one."""
    stored = [document("s", [reading("a", 0.0, None, "x"), reading("b", 1.0, "x", None), reading("z")])]
    _check(spark, [document("n1", [reading("a", 0.0, "x", None)]), document("n2", [reading("b", 1.0, None, "x")])], stored)
    _check(spark, [document("n3", [reading("a", 0.0, None, "x")]), document("n4", [reading("b", 1.0, "x", None)])], stored)
