"""Loading into star tables elsewhere; what is asked of a database is checked as text."""

import pytest

from helpers import document, documents, reading, rows_of
from sensormart.operators import upsert_facts
from sensormart.plans import load_into, trend_by_hour
from sensormart.schemas import FACT_TABLE, ID_COLUMNS, LOCATION_TABLE, NATURAL_KEYS, PARAMETER_TABLE, STAR, TIME_TABLE, empty_table
from sensormart.session import scratch_path
from sensormart.sources.jdbc import bounds_query, id_ranges, merge_statement


@pytest.mark.parametrize("least,greatest,parts", [(1, 100, 8), (1, 3, 8), (5, 5, 4), (None, None, 8), (1, 1000, 1), (-7, 9, 3)])
def test_every_id_is_in_one_range(least, greatest, parts):
    ranges = id_ranges(least, greatest, parts, "x")
    assert len(ranges) <= parts
    ids = [None, *range((least or 0) - 3, (greatest or 0) + 4)]

    def inside(text, x):
        def part(term):
            term = term.strip()
            if term == "1 = 1":
                return True
            if "IS NULL" in term:
                return x is None
            return x is not None and eval(term.replace("x", str(x)))  # noqa: S307

        return any(all(part(t) for t in side.split("AND")) for side in text.split("OR"))

    assert all(sum(inside(text, x) for text in ranges) == 1 for x in ids)
    if least is not None and len(ranges) > 2:
        sizes = [sum(inside(text, x) for x in range(least, greatest + 1)) for text in ranges]
        assert max(sizes) - min(sizes) <= 1


def test_texts():
    assert bounds_query(LOCATION_TABLE) == (
        "(SELECT MIN(location_id) AS least, MAX(location_id) AS greatest FROM dimension_location) bounds"
    )
    assert "ON CONFLICT (measurement_id)" in merge_statement("staged")


class Elsewhere:
    """Tables held as Parquet files of their own; appending fails where it is told to."""

    def __init__(self, spark):
        self.spark = spark
        self.tables = {table: empty_table(spark, table) for table in STAR}
        self.fail_on = None

    def keys(self, table):
        return self.tables[table].select(*NATURAL_KEYS[table], ID_COLUMNS[table])

    def append(self, table, rows):
        if table == self.fail_on:
            raise OSError(table)
        self._put(table, self.tables[table].unionByName(rows))

    def merge_facts(self, facts):
        self._put(FACT_TABLE, upsert_facts(self.tables[FACT_TABLE], facts))

    def _put(self, table, rows):
        path = scratch_path(self.spark, "elsewhere")
        rows.write.parquet(path)
        self.tables[table] = self.spark.read.schema(rows.schema).parquet(path)


def test_loads_can_be_repeated_and_continue_ids(spark):
    target = Elsewhere(spark)
    first = documents(spark, [document("a", [reading("co", 1.0), reading("co", 2.0)]), document("b", [reading("no2")], at=(3.0, 3.0))])
    target.fail_on = TIME_TABLE
    with pytest.raises(OSError):
        load_into(target, first)
    target.fail_on = None
    assert target.tables[FACT_TABLE].isEmpty()
    assert load_into(target, first)[TIME_TABLE] == 1
    assert load_into(target, first) == {LOCATION_TABLE: 0, PARAMETER_TABLE: 0, TIME_TABLE: 0}
    second = documents(spark, [document("a", [reading("co", 7.0)]), document("c", [reading("o3")], at=(0.0, 0.0))])
    assert load_into(target, second) == {LOCATION_TABLE: 1, PARAMETER_TABLE: 1, TIME_TABLE: 0}
    assert rows_of(target.tables[LOCATION_TABLE], "location_id", "latitude") == [(1, 1.0), (2, 3.0), (3, 0.0)]
    assert rows_of(target.tables[FACT_TABLE], "measurement_id", "location_id", "value") == [
        ("a_co", 1, 7.0), ("b_no2", 2, 1.0), ("c_o3", 3, 1.0),
    ]
    assert trend_by_hour(target.tables).count() == 3
