"""Fingerprints against a plain Python parser, and what locally consistent parsing promises."""

import hashlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensormart.llm import fingerprints as module
from sensormart.llm.fingerprints import compare_with_edits, edited_text, fingerprint_documents, fingerprints, likeness, phrases

WORD = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WORD
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WORD
    return x ^ (x >> 31)


def tossed(own, left):
    place = ((own ^ left) & -(own ^ left)).bit_length() - 1
    return 2 * place + (own >> place & 1)


def brute_level(symbols):
    """(name, length) pairs of one level to those of the next."""
    runs = []
    for name, group in groupby(symbols, key=lambda s: s[0]):
        lengths = [n for _, n in group]
        runs.append((mixed(name ^ mixed(len(lengths))) if len(lengths) > 1 else name, sum(lengths)))
    labels = [tossed(name, runs[i - 1][0] if i else 0) for i, (name, _) in enumerate(runs)]
    for _ in range(3):
        labels = [tossed(own, labels[i - 1] if i else own ^ 1) for i, own in enumerate(labels)]
    cuts = [0] + [i for i in range(2, len(runs) - 1) if labels[i - 1] < labels[i] > labels[i + 1]] + [len(runs)]
    out = []
    for start, end in zip(cuts, cuts[1:]):
        total = sum(name * pow(BASE, i, 1 << 64) for i, (name, _) in enumerate(runs[start:end])) & WORD
        out.append((mixed(total), sum(n for _, n in runs[start:end])))
    return out


def brute_phrases(text):
    symbols, found = [(mixed(ord(c) + (1 << 32)), 1) for c in text], []
    while symbols:
        symbols = brute_level(symbols)
        found += symbols
        if len(symbols) == 1:
            break
    return found


def brute_keys(text):
    keys = set()
    for name, length in brute_phrases(text):
        rank = np.float32(((name >> 11) + 0.5) * 2.0**-53 / length)
        keys.add(int(rank.view(np.uint32)) << 32 | name & 0xFFFFFFFF)
    return sorted(keys)[: module.KEEP]


def brute_likeness(a, b):
    both = sorted({*a, *b})[: module.KEEP]
    return sum(k in a and k in b for k in both) / len(both) if both else 1.0


def texts_of(rng, n, most):
    words = ["the", "of", "river", "stone", "\n", "aaaa", "été", "日本語", "x", "======", "and so on", "42"]
    return [" ".join(rng.choice(words, rng.integers(0, most))) for _ in range(n)]


ODD = ["", "a", "ab", "aaa", "aaaa", "abab" * 3, "ab" * 300, "a" * 5000, "\n\n\n\na", "\x00\x00\x01", "\U0001f600" * 9 + "x"]


@pytest.mark.parametrize("step", [1 << 16, 16])
def test_against_plain_python(monkeypatch, step):
    monkeypatch.setattr(module, "STEP", step)
    rng = np.random.default_rng(8)
    texts = ODD + texts_of(rng, 60, 40) + texts_of(rng, 6, 3000)
    for text, keys in zip(texts, fingerprints(texts), strict=True):
        assert keys.tolist() == brute_keys(text), text[:50]
    monkeypatch.setattr(module, "BATCH", 100)
    assert [k.tolist() for k in fingerprints(texts)] == [brute_keys(t) for t in texts]


def test_equal_substrings_share_interior_names_at_any_offset():
    rng = np.random.default_rng(2)
    shared = "".join(chr(c) for c in rng.integers(97, 123, 4000))
    sets = []
    for front in (0, 1, 7, 500):
        text = "".join(chr(c) for c in rng.integers(65, 91, front)) + shared
        levels = [set(names.tolist()) for _, names, _ in phrases([text])]
        sets.append(levels)
    for other in sets[1:]:
        for level, few in zip(range(4), (4, 4, 4, 4)):
            assert len(sets[0][level] - other[level]) <= few


def test_phrases_cover_the_text_and_shrink():
    rng = np.random.default_rng(3)
    texts = ODD + texts_of(rng, 30, 200)
    before = None
    for number, _, lengths in phrases(texts):
        for i in set(number.tolist()):
            assert lengths[number == i].sum() == len(texts[i])
        count = np.bincount(number, minlength=len(texts))
        assert before is None or ((count <= before // 2) | (count <= 1)).all()
        before = count


def test_likeness_orders_texts():
    rng = np.random.default_rng(5)
    words = ["".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 9))) for _ in range(800)]
    base, other = (" ".join(rng.choice(words, 1500)) for _ in range(2))
    found = fingerprints([base, base, edited_text(base, other), other])
    assert likeness(found[0], found[1]) == 1.0
    assert likeness(found[0], found[2]) > 0.3 > 0.15 > likeness(found[0], found[3])


def rows_of(table):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(map(tuple, compare_with_edits(table).select(*names).collect()), key=str)


def brute_rows(table):
    found = table.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    ordered = sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    out = []
    for row, after in zip(ordered, ordered[1:] + ordered[:1]):
        edited = edited_text(row.text, after.text)
        own, changed, following = (brute_keys(t) for t in (row.text, edited, after.text))
        name = lambda keys: "".join(f"{k:016x}" for k in keys)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = (brute_likeness(own, changed), brute_likeness(own, following))
        out.append((row.doc_id, len(row.text), digest, name(own), name(changed), *near))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, part int, edge_text string, fingerprint string"


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_odd_rows(spark, partitions):
    rng = np.random.default_rng(6)
    texts = texts_of(rng, 50, 60)
    rows = [(int(i), t) for i, t in zip(rng.permutation(500)[:50], texts)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (-5, "first")]
    rows += [(None, t) for t in texts[:20]] + [(None, None)] * 9 + [(7, "same")] * 9 + [(7, "other")]
    rows += [(3000, "lorem ipsum dolor " * 20_000)]
    table = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(table) == brute_rows(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_single(spark):
    assert rows_of(spark.createDataFrame([], SCHEMA)) == []
    single = spark.createDataFrame([(4, "one two three four", 1, "x", "y")], SCHEMA)
    assert rows_of(single) == brute_rows(single)


def test_without_a_shuffle(spark):
    table = spark.createDataFrame([(1, "abc def", 1, "x", "y"), (None, None, 1, "x", "y")], SCHEMA)
    found = fingerprint_documents(table)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    prints = {r.doc_id: r.fingerprint for r in found.collect()}
    assert prints[None] == "" and prints[1] == "".join(f"{k:016x}" for k in brute_keys("abc def"))
