"""Removal of repeated strings against all windows of all texts."""

import hashlib
import os
import pathlib
import random
from collections import Counter

import numpy as np
import pytest

from sensormart.llm import suffixes
from sensormart.session import scratch_path


def _brute(texts, threshold):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + threshold] for d in data for i in range(len(d) - threshold + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - threshold + 1):
            if seen[d[i : i + threshold]] > 1:
                gone[i : i + threshold] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _check(docs, threshold=suffixes.THRESHOLD):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = [(i, *x) for (i, _), x in zip(rows, _brute([t for _, t in rows], threshold), strict=True)]
    got = [tuple(r)[:5] for r in suffixes.find_repeats(docs, threshold).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    # At two depths at once.
    for passage in (suffixes.PASSAGE, suffixes.ANCHOR + 2 * suffixes.BLOCK):
        lower = _brute([t for _, t in rows], passage)
        expected = [(*row, less[1]) for row, less in zip(expected, lower, strict=True)]
        both = suffixes.find_repeats(docs, threshold, passage).drop("spans", "passages").collect()
        assert sorted(map(tuple, both), key=str) == sorted(expected, key=str)
        expected = [row[:-1] for row in expected]


def test_table(spark, sf_dir):
    _check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize("segment", [suffixes.SEGMENT, 300])
def test_runs(monkeypatch, segment):
    """Every suffix is in one run; equal windows have equal anchors at equal distances."""
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    rng = np.random.default_rng(8)
    part = rng.integers(97, 101, 900, dtype=np.uint8)
    for data in (np.concatenate([part, part[100:800], part[:450]]), np.full(1500, 97, np.uint8), part[:400]):
        first, number, distance, anchor, whole = suffixes.find_runs(data)
        starts = np.concatenate([np.arange(f, f + n) for f, n in zip(first, number, strict=True)])
        assert (starts == np.arange(len(data) - 399)).all()
        spots, seen = np.repeat(first + distance, number), {}
        for p, spot, value in zip(starts, spots, np.repeat(anchor, number), strict=True):
            mark = (spot - p, value, data[spot : spot + suffixes.ANCHOR].tobytes())
            assert 0 <= spot - p <= 400 - suffixes.ANCHOR and seen.setdefault(data[p : p + 400].tobytes(), mark) == mark
        again = {}
        for f, n, d, w in zip(first, number, distance, whole, strict=True):
            assert again.setdefault((n, w), data[f : f + n + 399].tobytes()) == data[f : f + n + 399].tobytes()


def test_passages_edits_and_odd_rows(spark):
    rng = random.Random(6)
    make = lambda n, letters="abcdefgh ": "".join(rng.choices(letters, k=n))
    base, passage = make(3000), make(700)
    texts = [base, base[:1500] + "X" + base[1500:], base[500:], "é" + base[:399], base[:400], base[1:400], base[:400] + "é"]
    texts += [make(rng.randint(0, 900)) + passage[rng.randint(0, 200) :][: rng.randint(300, 600)] + make(500) for _ in range(25)]
    texts += [make(450) * 3, "a" * 399, "a" * 400, "a" * 401, "ab" * 300, "b" * 1000, make(200, "éü") * 4, None, "", "x"]
    for _ in range(12):
        edited = list(base)
        for _ in range(rng.randint(1, 6)):
            edited[rng.randrange(len(edited))] = "Z"
        texts.append("".join(edited))
    texts += [texts[-1], texts[-2]]
    rows = list(enumerate(texts)) + [(None, make(900)), (5, texts[5]), (None, None), (None, passage)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, first int, key string")
    _check(docs.coalesce(2))
    _check(docs.limit(0))
    cut = suffixes.remove_repeats(docs.withColumn("n_chars", F_len())).collect()
    spans = {(r.doc_id, r.n_bytes): r.spans for r in suffixes.find_repeats(docs).collect()}
    assert len(cut) == len(rows)
    for row in cut:
        original = [t for i, t in rows if i == row.doc_id]
        if row.doc_id is not None and len(original) == 1:
            text = original[0]
            found = spans[row.doc_id, len((text or "").encode())] or []
            assert row.text == (suffixes.cut_text(text, [s.asDict() for s in found]) if found else text)
            assert row.first == 1 and row.key == "x" and row.n_chars == (None if text is None else len(row.text))


def F_len():
    from pyspark.sql import functions as F

    return F.length("text").cast("long")


def test_depths_are_bounded(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        suffixes.find_repeats(docs, suffixes.ANCHOR)
    _check(spark.createDataFrame([(1, "x" * 300), (2, "x" * 300), (3, "y" * 260 + "z" * 260)], docs.schema))


def test_cut_keeps_whole_characters():
    assert suffixes.cut_text("aébcéd", [{"start": 2, "end": 6}]) == "aéd"[:2] + "éd"
    assert suffixes.cut_text("日本", [{"start": 1, "end": 5}]) == "日本"
    assert suffixes.cut_text("日本", [{"start": 0, "end": 6}]) == ""


def test_a_digits_rows_are_removed(spark):
    """The runs of all texts, blocks and suffixes are gone once those still together are written."""
    common = " ".join(f"word{i}" for i in range(100))
    docs = spark.createDataFrame([(i, f"{i} " * 50 + common + f" {i * 7}" * 50) for i in range(8)], "doc_id long, text string")
    folder = pathlib.Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(os.listdir(folder)) if folder.exists() else set()
    assert suffixes.find_repeats(docs).filter("n_removed > 0").count() == 8
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert "spans" in left and not left & {"runs", "anchors", "runs-together", "blocks", "suffixes"}
