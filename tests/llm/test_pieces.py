"""Ids by pieces against the library's ids of whole texts."""

import random
import sys

import numpy as np
import pytest

from sensormart.llm.common import tokenizer_path
from sensormart.llm.pieces import SPACES, CountEncoder, IdEncoder, load_tokenizer

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [
    "", " ", "\n", "\n\n", "a", " a", "a ", "a\n", "\na", "a  b", "a \n b", "a\n\nb", "\t\ta", "a\t b", "a b",
    "x <|endoftext|> y", "<|endoftext|>", "a\0b", "don't, it's.", "we'll.  'S 's", "ÀÉ Ǆ İstanbul ΣΑΣ.", "é á,",
    "a\x1c b", "a\x1c\n b", "\x85x", "日本 語.", "x.,;", "...", "İİ Straße Ünï İstanbul x", "1,000.5!", "²,", "a​ b", "　a", "<|startoftext|>a",
]


@pytest.mark.parametrize("name", FILES)
def test_odd_texts(name):
    path = tokenizer_path(name)
    encoder, counter = IdEncoder(path, room=20), CountEncoder(path, room=20)
    tokenizer = load_tokenizer(path)
    rng = random.Random(5)
    alphabet = list("ab E.,;'’\n\n  \t9²éßÑ#$\x1c 　́") + ["the ", " of", "<|", "ing"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    got = [ids for i in range(0, len(texts), 50) for ids in encoder.encode(texts[i : i + 50])]
    assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == expected
    assert counter.encode(texts) == [len(ids) for ids in expected]


@pytest.mark.parametrize("name", FILES)
def test_white_space_of_the_library(name):
    """Exactly the listed characters are cut at, whatever stands beside them."""
    import re

    pre = load_tokenizer(tokenizer_path(FILES[0])).pre_tokenizer
    listed = re.compile(f"[{SPACES}]")
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000 or 0x3400 < code < 0xFE00 or code > 0x1FFFF:
            continue
        c = chr(code)
        # After a listed character the library ends its token; others attach to the space.
        joined = pre.pre_tokenize_str(f" {c}")[0][1] == (0, 2) and len(pre.pre_tokenize_str(f" {c}")) == 1
        space = joined and pre.pre_tokenize_str(f" {c}x")[0][1] == (0, 1) and c != " "
        assert space == (bool(listed.match(c)) and c != " "), hex(code)
