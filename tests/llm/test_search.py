"""Search against a brute-force version, and its exact products."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from sensormart.llm import search as module
from sensormart.llm.search import ItemTiles, best_rows, exact_parts, impacts, search, terms_of

DOCS = "doc_id long, text string, item_id string, score string"
ITEMS = "item_id long, text string, doc_id string, rank int"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t, *_ in docs]
    counts = [(d, c) for d, c in counts if c]
    n, size = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text, *_ in items:
        scored = []
        for d, c in counts:
            m = 25 + 75 * c.total() * n // size
            score = sum(
                q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, q in Counter(terms(text)).items()
                if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(rng, n, words, most):
    return [(i, " ".join(rng.choice(words, rng.integers(1, most))), "x", "y") for i in range(n)]


def got(found):
    return sorted(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


WORDS = ["alpha", "Beta", "gamma-delta", "éclair", "ÉCLAIR", "x1", "2024", "über", "日本", "the", "the", "of", "a_b"]


def odd_tables():
    rng = np.random.default_rng(4)
    docs = rows(rng, 150, WORDS, 30)
    docs += [(None, "alpha alpha"), (None, None), (200, ""), (201, "-- !!"), (202, "\x00\x7f\t"), (203, None)]
    docs += [(7, docs[7][1]), (7, "beta beta beta")]
    docs += [(300 + i, docs[3][1]) for i in range(80)]  # copies: a third of all rows tie
    docs += [(400, "long " * 400_000 + "alpha")]
    items = rows(rng, 90, WORDS + ["nowhere"], 6)
    items += [(None, "alpha beta"), (5, items[5][1]), (500, None), (501, ""), (502, "nowhere"), (503, "long long the")]
    return [(*r[:2], "x", "y") for r in docs], [(*r[:2], "z", 1) for r in items]


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    docs, items = odd_tables()
    found = search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS))
    assert got(found) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = odd_tables()
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert got(search(no_docs, spark.createDataFrame(items[:5], ITEMS))) == []
    assert got(search(spark.createDataFrame(docs[:5], DOCS), no_items)) == []
    assert got(search(spark.createDataFrame([(1, None, "", "")], DOCS), spark.createDataFrame(items[:5], ITEMS))) == []


def test_terms():
    for text in (" Ab9_É-é\x80  日本。x", "", "A" * 10, "a\x00b\x1cc"):
        assert [t.decode() for t in terms_of(text.encode())] == terms(text)


def test_pieces_cut_no_term(monkeypatch):
    monkeypatch.setattr(module, "PIECE", 7)
    text = b"one two threefourfive six" + b"s" * 40 + b" end"
    assert [t for p in module._pieces(text) for t in p] == terms_of(text)


def test_products_stay_exact_beyond_a_double():
    weights = np.array([30_000, 29_999, 7], np.int64)
    asked = [Counter({0: 5_000_000, 1: 3, 2: 1}), Counter({1: 9_999_999}), Counter()]
    tiles = ItemTiles(asked, weights)
    assert len(tiles.tiles[0][3]) > 10
    term, impact = np.array([0, 1, 2, 1]), np.array([999_983, 1, 999_999, 999_979])
    found = tiles.scores(np.array([0, 0, 0, 1]), term, impact, 2)
    for i, counter in enumerate(asked):
        for d, chosen in enumerate(([0, 1, 2], [3])):
            assert found[i, d] == sum(counter[int(term[e])] * int(weights[term[e]]) * int(impact[e]) for e in chosen)
    with pytest.raises(ValueError):
        exact_parts(np.array([[10**13]], object))


def test_lengths_beyond_64_bits():
    sizes, owner, counts = np.array([10**9, 3]), np.array([0, 1]), np.array([2, 1])
    n_docs, n_terms = 10**9, 7 * 10**11
    expected = [10**9 * c // (1000 * c + 8 * (25 + 75 * s * n_docs // n_terms)) for s, c in zip([10**9, 3], [2, 1])]
    assert impacts(sizes, owner, counts, n_docs, n_terms).tolist() == expected


def test_best_rows_take_the_smallest_ids_of_a_tie():
    import pyarrow as pa

    table = pa.table({"item": [0, 0, 0, 1, 0], "doc_id": [9, None, 2, 5, 4], "score": [7, 7, 7, 1, 8]})
    assert best_rows(table, 3).to_pylist() == [
        {"item": 0, "doc_id": 4, "score": 8},
        {"item": 0, "doc_id": 2, "score": 7},
        {"item": 0, "doc_id": 9, "score": 7},
        {"item": 1, "doc_id": 5, "score": 1},
    ]
