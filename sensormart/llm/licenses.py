"""License scans: notice phrases and identifier tags, with expressions evaluated."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sensormart.llm.common import slices, text_or_empty

# The phrases that make the base labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Further names of licenses, and sentences that only they contain.
NAMES = {
    "affero general public license": "agpl",
    "apache 2 0 license": "apache",
    "boost software license": "bsl",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "bsd license": "bsd",
    "creative commons attribution": "cc-by",
    "eclipse public license": "epl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "mozilla public license": "mpl",
}
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products": "bsd",
    "you may not use this file except in compliance with the license": "apache",
    "redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "redistribute it and or modify it under the terms of the gnu affero general public license": "agpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "made available under the terms of the eclipse public license": "epl",
    "distributed under the boost software license version 1 0": "bsl",
    "altered source versions must be plainly marked as such": "zlib",
    "waived all copyright and related or neighboring rights": "cc0",
}
TAG = "spdx license identifier"
# Families of identifiers, by their first part, that are permissive.
PERMISSIVE = {"0bsd", "apache", "boost", "bsd", "bsl", "cc0", "isc", "mit", "unlicense", "zlib"}
#: How much each kind of evidence leaves open.
DOUBT = {"tag": 0.05, "sentence": 0.2, "name": 0.5}

#: Bytes to lower case, and everything that is not part of a word to spaces.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_TAGGED = re.compile(r"(?i)spdx-license-identifier\s*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*)")
_RANK = {"or": 1, "and": 2, "with": 3}


@functools.cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    phrases = [(p, "base", x) for p, x in BASE_PHRASES.items()] + [(TAG, "tag", None)]
    phrases += [(p, "name", x) for p, x in NAMES.items()] + [(p, "sentence", x) for p, x in SENTENCES.items()]
    for phrase, kind, label in phrases:
        found.add_word(f" {phrase} ", (len(phrase) + 2, kind, label))
    found.make_automaton()
    return found


# -- expressions -------------------------------------------------------------
def postfix(text: str) -> list[str] | None:
    """The license expression at the start of ``text`` in postfix order.

    Shunting-yard: operands go out, operators wait until one that binds no
    tighter comes. The expression ends where the grammar cannot go on; an operator
    left without its right side is dropped. None if nothing or no whole
    parenthesis stands there.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand_next, place = True, 0
    while match := _TOKEN.match(text, place):
        token = match[1]
        word = token.lower()
        if word in _RANK:
            if operand_next:
                break
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            waiting.append(token)
        elif token == ")":
            if operand_next or "(" not in waiting:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            if not operand_next:
                break
            out.append(word.rstrip(".:"))
            operand_next = False
        place = match.end()
    if operand_next and waiting and waiting[-1] != "(":
        waiting.pop()
    if not out or "(" in waiting:
        return None
    return out + waiting[::-1]


def family(identifier: str) -> str:
    """The label of an identifier: its first part, with the GNU family told apart."""
    return identifier.removeprefix("licenseref-").split("-")[0].rstrip("+") or identifier


def evaluate(expression: list[str]) -> tuple[str, set[str], bool]:
    """An expression in full parentheses, its labels, and whether permissive terms suffice.

    ``or`` needs one permissive side, ``and`` both; ``with`` adds an exception to
    the license on its left and is judged, and labelled, by that license alone.
    """
    stack: list[tuple[str, set[str], bool]] = []
    for token in expression:
        if token in _RANK:
            right, left = stack.pop(), stack.pop()
            labels = left[1] if token == "with" else left[1] | right[1]
            free = {"or": left[2] or right[2], "and": left[2] and right[2], "with": left[2]}[token]
            stack.append((f"({left[0]} {token} {right[0]})", labels, free))
        else:
            stack.append((token, {family(token)}, family(token) in PERMISSIVE))
    return stack.pop()


# -- texts -------------------------------------------------------------------
def scan_text(text: str) -> dict:
    words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    normal = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    base, other, doubt, tagged = [], set(), 1.0, False
    evidence = set()
    place, before = 0, 0  # how many spaces lie before a place, counted on from the last one
    for end, (length, kind, label) in automaton().iter(normal):
        if kind == "base":
            first = end - length + 1
            step = normal.count(" ", place, first) if first >= place else -normal.count(" ", first, place)
            place, before = first, before + step
            base.append((before, label))
            evidence.add(("name", label))
        elif kind == "tag":
            tagged = True
        else:
            other.add(label)
            evidence.add((kind, label))
    expressions, free = [], None
    for match in _TAGGED.finditer(text) if tagged else ():
        if (parsed := postfix(match[1])) is not None:
            whole, labels, permissive = evaluate(parsed)
            expressions.append(whole)
            other |= labels
            evidence |= {("tag", label) for label in labels}
            free = permissive if free is None else free and permissive
    for kind, _ in sorted(evidence):
        doubt *= DOUBT[kind]
    base_labels = {label for _, label in base}
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min(base)[0] if base else None,
        "last_word": max(base)[0] if base else None,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | other)),
        "score": round(1 - doubt, 6),
        "expressions": expressions,
        "permissive": free,
    }


_RESULT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("expressions", pa.list_(pa.string())),
        ("permissive", pa.bool_()),
    ]
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License evidence of every whole text, without any shuffle.

    Words are runs of digits, letters a-z (after lower-casing A-Z) and characters
    from U+0080. One automaton finds all phrases as consecutive words; where an
    identifier tag is among them, the expressions behind the tags are parsed.

    Returns doc_id, n_words, n_base (places of base phrases), first_word and
    last_word (their smallest and largest first word), base_labels and labels
    (distinct, sorted, joined by commas; labels adds other names, sentences and
    identifiers), score (0 without evidence, towards 1 with more), expressions
    (in full parentheses), permissive (null without expressions). A null text is
    empty: no words, empty labels, score 0. Null and repeated doc_ids keep a row
    each; other columns are not read; an empty table gives no rows.
    """
    narrow = docs.select("doc_id", text_or_empty().alias("text"))
    doc_id = narrow.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = pa.RecordBatch.from_pylist([scan_text(t) for t in part.column("text").to_pylist()], _RESULT)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *rows.columns], ["doc_id", *_RESULT.names]
                )

    return narrow.mapInArrow(
        scan,
        f"doc_id {doc_id}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, permissive boolean",
    )
