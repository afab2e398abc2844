"""Packing and token counts against the library, text by text."""

import zlib

import numpy as np
import pytest

from sensormart.llm.common import tokenizer_path
from sensormart.llm.packing import binary_lengths, pack_documents
from sensormart.llm.pieces import load_tokenizer
from sensormart.llm.token_counts import count_tokens

TEXTS = [None, "", "one", "Two words, here.", "x " * 5000, "tail  of\n\nspaces ", "<|endoftext|>"]


@pytest.fixture()
def odd_docs(spark):
    """Null ids, repeated rows, and columns named like the results."""
    rows = [(i, t, 7, "c") for i, t in enumerate(TEXTS)] + [(None, "no id", 7, "c"), (1, "", 7, "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")


def _rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def _check_packed(docs, packed, limit=2048):
    tokenizer = load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    expected = []
    for doc_id, text in _rows(docs):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        start = 0
        for length in binary_lengths(len(ids), limit):
            part = np.array(ids[start : start + length], "<u4").tobytes()
            expected.append((doc_id, start, length, zlib.crc32(part), len(ids)))
            start += length
    rows = packed.collect()
    got = [(r.doc_id, r.start, r.length, zlib.crc32(r.ids), r.doc_tokens) for r in rows]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.offset == 0 and r.length == 1 << r.bucket <= limit for r in rows)
    assert [r.bucket for r in sorted(rows, key=lambda r: r.sequence_id)] == sorted(r.bucket for r in rows)


def test_binary_lengths():
    for n in range(1, 300):
        lengths = binary_lengths(n, 64)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(x & (x - 1) == 0 and x <= 64 for x in lengths)


def test_packing(odd_docs):
    _check_packed(odd_docs, pack_documents(odd_docs))
    _check_packed(odd_docs, pack_documents(odd_docs, max_tokens=16), 16)


def test_packing_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    _check_packed(docs, pack_documents(docs))


def _check_counts(docs):
    tokenizer = load_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    expected = sorted(
        (d if d is not None else -1, len(t.encode()), n := len(tokenizer.encode(t, add_special_tokens=False).ids), n > 1024)
        for d, t in _rows(docs)
    )
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in count_tokens(docs).collect())
    assert got == expected


def test_counts(odd_docs, spark, sf_dir):
    _check_counts(odd_docs)
    _check_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_empty_tables(odd_docs):
    none = odd_docs.limit(0)
    assert count_tokens(none).collect() == [] and pack_documents(none).collect() == []


def test_frequent_pieces_are_those_of_all_texts(spark, monkeypatch):
    """Not those of the first texts or of their first characters."""
    from sensormart.llm import token_counts

    rows = [(i, f"first{chr(97 + i % 20)}a " + "the " * 5 + f" tail{chr(97 + i % 7)} last") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert token_counts.frequent_pieces(docs, 2) == ["the", "last"]
    monkeypatch.setattr(token_counts, "COUNTERS", 4)
    assert token_counts.frequent_pieces(docs, 1) == ["the"]
    packed, lengths = token_counts.frequent_lengths(docs, "byte_bpe_50k.json")
    assert len(packed.split("\0")) == len(lengths)
