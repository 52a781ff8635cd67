"""Many phrases in one pass: the automaton and the join on it."""

from __future__ import annotations

import random

import pytest

from feedlens.functions import automaton
from feedlens.operators import contains
from feedlens.operators.contains import contains_join


@pytest.mark.parametrize("window, anchor", [(37, 4), (500, 12), (1 << 21, 1), (1 << 21, 30)])
def test_overlapping_phrases(monkeypatch, window, anchor):
    monkeypatch.setattr(automaton, "WINDOW", window)
    rng = random.Random(window + anchor)
    for _ in range(25):
        phrases = list({"".join(rng.choice("abé ") for _ in range(rng.randrange(1, 24))).encode() for _ in range(rng.randrange(1, 40))})
        texts = ["".join(rng.choice("abéc ") for _ in range(rng.choice([0, 3, 50, 2000]))).encode() for _ in range(rng.randrange(1, 20))]
        texts[0] += phrases[0] + phrases[-1]
        found = automaton.Automaton(phrases, anchor).find(texts)
        assert found == [[i for i, p in enumerate(phrases) if p in t] for t in texts]


def test_phrases_within_phrases_and_separators():
    phrases = [b"a" * n for n in range(1, 40)] + [b"\0", b"b\0a"]
    texts = [b"a" * 20, b"b\0a", b"", b"\0", b"ab", b"a" * 100]
    found = automaton.Automaton(phrases).find(texts)
    assert found == [[i for i, p in enumerate(phrases) if p in t] for t in texts]


def test_a_text_of_ten_million_characters(spark):
    long = "x " * 5_000_000 + "the end"
    texts = spark.createDataFrame([(1, long), (2, None), (3, "x the"), (4, "")], "id int, t string")
    phrases = spark.createDataFrame([("the end",), ("x the",), ("y",), (None,), ("",)], "p string")
    for forced in (False, True):
        got = contains_join(texts, "t", phrases, "p", forced).select("id", "p").collect()
        assert sorted(map(tuple, got)) == [(1, "the end"), (1, "x the"), (3, "x the")]


def test_blocks_of_phrases(spark, monkeypatch):
    monkeypatch.setattr(contains, "MAX_INLINE_PHRASES", 5)
    monkeypatch.setattr(contains, "TABLE_BITS", 100 * contains.ROW_BITS)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(2, 15))) for _ in range(90)]
    texts = [(i, "".join(rng.choice("abcde") for _ in range(300))) for i in range(20)]
    named = spark.createDataFrame([(i, w) for i, w in enumerate(words * 2)], "n int, w string")
    blocks = contains._blocks(named, "w")
    assert len(blocks) > 2 and sorted(sum(blocks, [])) == sorted(set(words))
    got = contains_join(spark.createDataFrame(texts, "id int, t string"), "t", named, "w").select("id", "n").collect()
    assert sorted(map(tuple, got)) == sorted((i, n) for i, t in texts for n, w in enumerate(words * 2) if w in t)
