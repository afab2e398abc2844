"""Near-duplicates against all pairs, and the parts of the method."""

import random
import re

import numpy as np

from sensormart.llm import minhash
from sensormart.llm.components import connected_components


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def _set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = [_set(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j}
    links = [(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    group = brute_components(range(len(rows)), links)
    smallest = {}
    for i, g in group.items():
        ids = [x for x in (smallest.get(g), rows[i][0]) if x is not None]
        smallest[g] = min(ids) if ids else None
    expected = [(rows[i][0], len(sets[i]), smallest[g], rows[i][0] == smallest[g]) for i, g in group.items()]
    got = [tuple(r)[:4] for r in minhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_table(spark, sf_dir):
    _check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_chains_passages_and_odd_rows(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 10**6))
    base = [word() for _ in range(200)]
    texts = []
    for i in range(25):  # a chain: neighbours are similar, the ends are not
        base = base[:]
        base[rng.randint(0, 199)] = word()
        texts.append(" ".join(base))
    family = [word() for _ in range(120)]
    for i in range(30):  # copies of one text with an edit each
        copy = family[:]
        copy[4 * i % 120] = word()
        texts.append(" ".join(copy))
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(60)] + passage) for _ in range(40)]
    texts += [None, "", " \n", "one", "One", "one two", "a b c d", "A b\tC d", "a b c d e", texts[0].upper().replace("A", "a")]
    rows = list(enumerate(texts)) + [(None, texts[30]), (None, "no id at all"), (3, texts[3]), (3, "other text"), (None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node int, bands string")
    _check(docs)
    _check(docs.limit(0))
    _check(docs.filter("doc_id = 3 or text is null"))


def test_large_families(spark, monkeypatch):
    """Copies with many edits, around the threshold, some sharing an edit: compared by the bound."""
    monkeypatch.setattr(minhash, "SMALL_FAMILY", 8)
    monkeypatch.setattr(minhash, "CORE_SAMPLE", 6)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    edits = [[(rng.randrange(150), f"e{k}-{i}") for i in range(rng.randint(1, 3))] for k in range(12)]
    texts = [" ".join(base)]
    for _ in range(110):
        copy = base[: rng.choice([150, 150, 140, 120])]
        for place, word in [e for k in rng.sample(range(12), rng.randint(0, 2)) for e in edits[k]]:
            if place < len(copy):
                copy[place] = word
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 10**9)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check(docs)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        a, b = (rng.integers(0, 1 << 62, 3000, dtype=np.uint64) for _ in range(2))
        b[: int(3000 * share)] = a[: int(3000 * share)]
        true = int(3000 * share) / (6000 - int(3000 * share))
        same = (minhash.signature(a) == minhash.signature(b)).mean()
        assert abs(same - true) < 0.15


def test_hashes_count_the_set():
    for text in ["", "a", "a b", "a b c d e", "a b c d e a b c d e a b c d e", "x " * 50, "é ü 日 本 語 a b"]:
        assert len(minhash.shingle_hashes(minhash.words_of(text))) == len(_set(text))


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    links += [(rng.randint(300, 360), rng.randint(300, 360)) for _ in range(50)]
    nodes = {n for a, b in links for n in (a, b) if a != b}
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(n, c) for n, c in brute_components(range(400), links).items() if n in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_two_bands_miss_as_seldom_as_stated():
    """At similarity 0.75 fewer than two common bands occur in at most 5.5 of a million cases."""
    same = minhash.SIMILAR**minhash.ROWS
    none = (1 - same) ** minhash.BANDS
    assert none + minhash.BANDS * same * (1 - same) ** (minhash.BANDS - 1) < 5.5e-6


def test_pair_whose_only_early_band_is_shared_with_others(spark):
    """Two similar texts meet in one of the first 32 bands, and there only among many short texts."""
    keys = lambda text: minhash.band_keys(minhash.signature(minhash.shingle_hashes(minhash.words_of(text))))
    head = [f"h1480x{i}" for i in range(76)]
    pair = [" ".join(head + [f"{side}1480y{i}" for i in range(12)]) for side in "ab"]
    common = np.flatnonzero(keys(pair[0]) == keys(pair[1]))
    assert (common < 32).sum() == 1
    band = int(common[0])
    # The passages of the head whose shingles the band is made of.
    passages = [" ".join(head[i : i + 5]) for i in range(72)]
    whole = minhash.signature(minhash.shingle_hashes(minhash.words_of(pair[0])))
    rows = slice(band * minhash.ROWS, (band + 1) * minhash.ROWS)
    least = [minhash.signature(minhash.shingle_hashes(minhash.words_of(p)))[rows] == whole[rows] for p in passages]
    needed = [p for p, hit in zip(passages, least, strict=True) if hit.any()]
    others, n = [], 0
    while len(others) < 8:
        n += 1
        text = " ".join(f"f{n}a{i} {p}" for i, p in enumerate(needed))
        if keys(text)[band] == keys(pair[0])[band]:
            others.append(text)
    docs = spark.createDataFrame(list(enumerate(others + pair)), "doc_id long, text string")
    # The short texts come first: the pair is neither with a first holder nor with a pivot.
    classes = minhash.sign_documents(docs).selectExpr("text_key", "doc_id AS least_id", "n_shingles", "bands", "doc_id AS node")
    assert sorted(map(tuple, minhash.find_links(docs, classes).collect())) == [(8, 8), (9, 8)]
    _check(docs)
