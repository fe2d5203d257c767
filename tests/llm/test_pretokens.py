from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex

from marketlens.llm import pretokens
from marketlens.llm.pretokens import Block, expand

PATTERN = regex.compile(public_tokenizers.PATTERN)
ALPHABET = "aбé漢 ß12²Ⅷ½'''stmdrevl  \n\t\r  \u0085\x1c!?#_\U0001f600́"


def pieces_of(texts):
    block = Block(texts)
    words = [block.words[c] for c in block.codes]
    out, at = [], 0
    for n in block.counts:
        out.append(words[at:at + n])
        at += n
    assert at == len(words) and len(set(block.words)) == len(block.words)
    return out


def test_same_pieces_as_the_pattern():
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 30))) for _ in range(4000)]
    texts += ["", " ", "'", "'s", "''s", " 's", "x's's", "I'll've", "\n\n x", "a\n\n", "'re", "'r", "a'"]
    assert pieces_of(texts) == [PATTERN.findall(t) for t in texts]


@pytest.mark.parametrize("unit", ["word and ", "x", "ab1", "\n", "漢字 ", "a'll "])
def test_long_texts_are_cut_between_pieces(monkeypatch, unit):
    monkeypatch.setattr(pretokens, "CHUNK", 64)
    pretokens.powers.cache_clear()
    texts = [unit * 40, "short", unit * 7, ""]
    try:
        assert pieces_of(texts) == [PATTERN.findall(t) for t in texts]
    finally:
        pretokens.powers.cache_clear()


def test_no_texts():
    assert pieces_of([]) == [] and pieces_of([""]) == [[]]


def test_expand():
    flat, lengths = np.array([7, 8, 9, 1]), np.array([3, 0, 1])
    offsets = np.array([0, 3, 3])
    assert expand(np.array([2, 0, 1, 2]), lengths, offsets, flat).tolist() == [1, 7, 8, 9, 1]
    assert expand(np.array([], int), lengths, offsets, flat).tolist() == []
