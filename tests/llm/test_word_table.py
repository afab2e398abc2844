"""Ids by the table of words against the library's ids of whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_pieces import FILES, ODD

from sensormart.llm import word_table
from sensormart.llm.common import tokenizer_path
from sensormart.llm.pieces import load_tokenizer
from sensormart.llm.word_table import WordTable, split_ids, with_end

LONG = ["x" * n + " y" for n in (7, 8, 9, 15, 16, 17, 39, 40, 41, 500)] + ["日" * 13 + " é" * 20, "日" * 14, "a" * 40 + "b", "a" * 40 + "c"]


def _texts(seed, n):
    rng = random.Random(seed)
    alphabet = list("ab E.,;'’\n\n  \t9²éßÑ#$\x1c \u3000\u0301") + ["the ", " of", "<|", "ing", "word, word", "<", "|"]
    plain = ["the", "word", "of,", "été", "日本", "x1", "and", "\nline", "Hello."]
    odd = ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(n)]
    return odd + [" ".join(rng.choices(plain, k=rng.randint(1, 80))) for _ in range(n)]


def _check(table, tokenizer, texts, column=None):
    ids, counts = table.encode(pa.array(texts, pa.string()) if column is None else column)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in split_ids(ids, counts)] == expected


@pytest.mark.parametrize("name", FILES)
def test_odd_texts(name):
    path = tokenizer_path(name)
    table, tokenizer = WordTable(path), load_tokenizer(path)
    texts = ODD + LONG + _texts(5, 1500)
    random.Random(1).shuffle(texts)
    for start in range(0, len(texts), 200):
        _check(table, tokenizer, texts[start : start + 200])
    _check(table, tokenizer, texts)  # all known by now
    for text in ODD:
        _check(table, tokenizer, [text])
    _check(table, tokenizer, [])
    sliced = pa.array(["cut off", *texts[:50], "and this"], pa.string()).slice(1, 50)
    _check(table, tokenizer, texts[:50], sliced)


def test_the_table_grows_and_starts_anew(monkeypatch):
    path = tokenizer_path(FILES[0])
    tokenizer = load_tokenizer(path)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 12))) for _ in range(60_000)]
    table = WordTable(path)
    for start in range(0, len(words), 20_000):
        _check(table, tokenizer, [" ".join(words[start : start + 20_000])])
    assert table.count > 50_000 and len(table.hashes) >= 2 * table.count
    monkeypatch.setattr(word_table, "MOST_WORDS", 100)
    for start in range(0, 2000, 500):
        _check(table, tokenizer, [" ".join(words[start : start + 500])])
    assert table.count < 2000 + 10 and len(table.hashes) == 1 << 16


def test_words_with_one_hash_place_are_told_apart():
    table = WordTable(tokenizer_path(FILES[0]))
    hashes = np.array([5 + (n << 40) for n in range(300)], np.uint64)  # all want one place
    table._put(hashes, np.arange(300, dtype=np.int32))
    assert table._find(hashes).tolist() == list(range(300))
    assert table._find(hashes + np.uint64(1)).tolist() == [-1] * 300


def test_end_ids():
    ids, counts = with_end(np.array([7, 8, 9], np.uint16), np.array([2, 0, 1]), 70_000)
    assert ids.tolist() == [7, 8, 70_000, 70_000, 9, 70_000] and counts.tolist() == [3, 1, 2] and ids.dtype == "<u4"
