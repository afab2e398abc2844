"""Pages by number and by cursor."""

from helpers import document, documents, reading, rows_of
from sensormart.operators import cursor_of, latest_page, page_after, with_newest


def _docs(spark, n=1200):
    rows = [
        document(f"d{i:05}", [reading("co", at=f"2024-07-{1 + i * 7 % 28:02}T{i % 24:02}:00:00Z"), reading("no", at="garbage")])
        for i in range(n)
    ]
    return documents(spark, [*rows, document("e1", []), document("e2", None), document("e3", [reading(at="garbage")])])


def test_deep_page_by_cursor(spark, tmp_path):
    """Page 1,000 of one document each, from the end of page 999, by both forms."""
    with_newest(_docs(spark)).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    before = latest_page(docs, 999, 1).select("_id.oid", "newest").first()
    page = page_after(docs, (before.newest, before.oid), 1)
    assert rows_of(page, "_id.oid") == rows_of(latest_page(docs, 1000, 1), "_id.oid")
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=1," in plan and "PushedFilters: [Or(" in plan
    assert "LessThanOrEqual(newest" in plan


def test_all_pages_in_order(spark):
    docs, cursor, seen = _docs(spark, 60), None, []
    while True:
        page = page_after(docs, cursor, 7)
        rows = page.collect()
        if not rows:
            assert cursor_of(page) is None
            break
        seen += [r._id.oid for r in rows]
        cursor = cursor_of(page)
    assert seen[-3:] == ["e1", "e2", "e3"] and len(seen) == len(set(seen)) == 63
    assert seen[:60] == [r._id.oid for r in latest_page(docs, 1, 60).collect()]
