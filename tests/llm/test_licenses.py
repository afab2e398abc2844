"""License scans against a plain search, and the expression parser."""

import re

import pytest

from sensormart.llm import licenses


def _words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def _base(text):
    words = _words(text)
    places = [
        (i, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = sorted(i for i, _ in places)
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), *((starts[0], starts[-1]) if starts else (None, None)), labels


TEXTS = [
    None, "", "MIT License", "the mit-license, MIT\nLICENSE mit license", "mitlicense", "ámit license", "mit licenses",
    "GNU Lesser General Public License", "Licensed under the Apache License, Version 2.0. MIT License " * 400,
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-or-later) AND Apache-2.0 */", "spdx license identifier none",
    "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0\nMIT", "SPDX-License-Identifier:",
]


def test_texts(spark, sf_dir):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "x", 1)], "doc_id long, text string, n_words int")
    for table in (docs, spark.read.parquet(f"{sf_dir}/documents.parquet"), docs.limit(0)):
        got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(table).collect()}
        assert got == {(r.doc_id, *_base(r.text)) for r in table.select("doc_id", "text").collect()}
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert all(0 <= r.score < 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in rows.values())
    assert rows[9].labels == "apache,gpl,mit" and rows[9].permissive and rows[9].base_labels == ""
    assert rows[9].expressions == ["((mit or gpl-2.0-or-later) and apache-2.0)"]
    assert rows[11].labels == "gpl" and not rows[11].permissive
    assert rows[7].labels == "gpl,lgpl" and rows[12].labels == "" and rows[12].permissive is None


def _labels_and_score(text):
    """All phrases sought at every word, tags by a search of their own."""
    words, evidence = _words(text), set()
    for kind, phrases in (("name", licenses.BASE_PHRASES), ("name", licenses.NAMES), ("sentence", licenses.SENTENCES)):
        for phrase, label in phrases.items():
            own = phrase.split()
            if any(words[i : i + len(own)] == own for i in range(len(words))):
                evidence.add((kind, label))
    for line in (text or "").splitlines():
        for rest in re.split("(?i)spdx-license-identifier", line)[1:]:
            found = licenses.postfix(rest.split(":", 1)[1]) if rest.lstrip().startswith(":") else None
            evidence |= {("tag", label) for label in licenses.evaluate(found)[1]} if found else set()
    left = 1.0
    for kind, _ in sorted(evidence):
        left *= licenses.DOUBT[kind]
    return ",".join(sorted({label for _, label in evidence})), round(1 - left, 6)


def test_labels_and_score(sf_dir):
    import random

    import pyarrow.parquet as pq

    rng = random.Random(3)
    phrases = [*licenses.BASE_PHRASES, *licenses.NAMES, *licenses.SENTENCES, "SPDX-License-Identifier: MIT OR (GPL-2.0-only AND ISC)"]
    marks = [" ", ", ", "\n", " -- ", ". The ", " x "]
    texts = [
        "".join(rng.choice(marks) + (p.title() if rng.random() < 0.5 else p) for p in rng.sample(phrases, rng.randint(0, 5)))
        for _ in range(400)
    ]
    texts += [" ".join(p.split()[:-1]) for p in phrases]  # cut short: another phrase, or none
    texts += [t or "" for t in pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()]
    seen = set()
    for text in texts:
        found = licenses.scan_text(text)
        assert (found["labels"], found["score"]) == _labels_and_score(text), text[:200]
        seen |= set(found["labels"].split(","))
    assert {"mit", "apache", "gpl", "lgpl", "agpl", "mpl", "epl", "bsl", "bsd", "isc", "zlib", "cc0", "unlicense", "cc-by"} <= seen


def test_a_very_long_text_costs_in_proportion():
    import time

    seconds = []
    for n in (50_000, 400_000):
        start = time.process_time()
        found = licenses.scan_text("mit license and the apache license " * n)
        seconds.append(time.process_time() - start)
        assert (found["n_base"], found["first_word"], found["last_word"]) == (2 * n, 0, 6 * n - 2)
    assert seconds[1] < 40 * seconds[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("MIT", "mit"),
        ("MIT or Apache-2.0 and BSD-3-Clause", "(mit or (apache-2.0 and bsd-3-clause))"),
        ("(MIT or Apache-2.0) and ISC", "((mit or apache-2.0) and isc)"),
        ("GPL-2.0+ with x-1 or MIT", "((gpl-2.0+ with x-1) or mit)"),
        ("MIT. Some prose", "mit"),
        ("MIT AND */", "mit"),
        ("((MIT))", "mit"),
        ("MIT)", "mit"),
        ("(MIT", None),
        ("AND MIT", None),
        ("", None),
        ("()", None),
    ],
)
def test_expressions(text, expected):
    parsed = licenses.postfix(text)
    assert (parsed and licenses.evaluate(parsed)[0]) == expected
