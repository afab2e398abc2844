"""Each stage of the pipeline against plain Python on what its predecessor kept."""

from collections import Counter

import numpy as np
from test_minhash import _set, brute_components
from test_mixing import _brute as brute_mix
from test_mixing import _size
from test_quality import _brute as brute_quality
from test_suffixes import _brute as brute_repeats

import corpus_pipeline
from sensormart.llm.common import tokenizer_path
from sensormart.llm.pieces import load_tokenizer
from sensormart.llm.suffixes import PASSAGE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(docs):
    return [tuple(r) for r in docs.select(*COLUMNS).collect()]


def _near_kept(rows):
    sets = [_set(r[1]) for r in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    group = brute_components(range(len(rows)), links)
    least = {}
    for i, g in group.items():
        least[g] = min(least.get(g, i), i, key=lambda k: rows[k][0])
    return [rows[i] for i, g in group.items() if least[g] == i]


def test_stages(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    rows = _rows(docs)

    kept = stages["quality rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    good = {r[0] for r in brute_quality([r[:2] for r in rows], labels) if r[-1]}
    expected = [r for r in rows if r[0] in good]
    assert sorted(_rows(kept)) == sorted(expected)

    frame = spark.createDataFrame(expected, docs.schema)
    kept = stages["near-duplicates"](spark, frame, sf_dir)
    expected = _near_kept(expected)
    assert kept.columns == docs.columns and sorted(_rows(kept)) == sorted(expected)

    frame = spark.createDataFrame(expected, docs.schema)
    cut = stages["repeated strings"](spark, frame, sf_dir)
    assert cut.columns == docs.columns
    got = {r[0]: r for r in _rows(cut)}
    assert len(got) == len(expected)
    for row, (_, removed, _, _) in zip(expected, brute_repeats([r[1] for r in expected], PASSAGE), strict=True):
        text = got[row[0]][1]
        left = len(row[1].encode()) - removed
        assert text == row[1] if not removed else left <= len(text.encode()) <= left + 6
        assert got[row[0]][4] == len(text) and got[row[0]][2:4] == row[2:4]

    expected = list(got.values())
    frame = spark.createDataFrame(expected, docs.schema)
    mixed = stages["mix"](spark, frame, sf_dir)
    taken = brute_mix([(r[0], r[1], r[3]) for r in expected])[0]
    wanted = Counter({r: taken[d] for r in expected for d in taken if d[:3] == (r[0], r[3], _size(r[1]))})
    assert mixed.columns == docs.columns and Counter(_rows(mixed)) == +wanted

    packed = stages["pack"](spark, mixed, sf_dir).collect()
    tokenizer = load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    ids = Counter()
    for r in packed:
        ids[r.doc_id] += r.length
        assert len(np.frombuffer(r.ids, "<u4")) == r.length
    length = {r[0]: len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in expected}
    assert ids == Counter({r[0]: length[r[0]] * n for r, n in wanted.items() if n})


def test_run_and_empty_input(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).filter("length > 2048 or offset <> 0").count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)


def test_odd_rows_pass_every_stage(spark, sf_dir):
    """Nulls in any column, repeated rows and extra columns with clashing names."""
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "a", 5, 1, "x"), (1, text, "en", "a", 5, 1, "x"), (None, text, None, None, None, None, None)]
    rows += [(2, None, None, "b", None, 2, "y"), (3, "", "en", None, 0, 3, "z"), (None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, row string"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "pack":
            assert out.columns == docs.columns
        found = out.collect()
        if name == "near-duplicates":
            assert sum(r.text == text for r in found) == 1 and len(found) == 4
