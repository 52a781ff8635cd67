from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from feedlens.llm import lattice_lm as lm
from feedlens.llm.common import TOKENIZER


def _plain(word, scores):
    """Sum over all segmentations, by recursion."""
    if not word:
        return 1.0
    return sum(scores[word[:n]] * _plain(word[n:], scores) for n in range(1, len(word) + 1) if word[:n] in scores)


@pytest.fixture(scope="module")
def small():
    pieces = [b"a", b"b", b"c", b"ab", b"abc", b"ca", b"bb"]
    weight = np.array([5, 3, 2, 4, 1, 2, 1.0])
    weight = np.stack([weight, weight[::-1]], axis=1)
    return lm.Lattice(pieces, np.log(0.8 * weight / weight.sum(axis=0)), np.log([0.2, 0.2]))


def test_marginals_equal_enumeration(small):
    words = [b"a", b"abc", b"abcab", b"bbbb", b"cabcabca", b"cc"]
    got = small.log_marginals(words)
    for kind in (0, 1):
        scores = dict(zip(small.pieces, np.exp(small.scores[:, kind])))
        with np.errstate(divide="ignore"):
            assert np.allclose(got[:, kind], np.log([_plain(w, scores) * 0.2 / 0.8 for w in words]))


def test_marginals_sum_to_one_over_short_words():
    lattice = lm.Lattice([b"a", b"b", b"ab"], np.log([[0.2], [0.1], [0.1]]), np.log([0.6]))
    total, words = 0.0, [b""]
    for _ in range(12):
        words = [w + c for w in words for c in (b"a", b"b")]
        total += np.exp(lattice.log_marginals(words)).sum()
    assert total == pytest.approx(1, abs=1e-3)


def test_expected_uses_equal_enumeration(small):
    scores = dict(zip(small.pieces, np.exp(small.scores[:, 1])))

    def paths(word):
        if not word:
            yield 1.0, []
        for n in range(1, len(word) + 1):
            if word[:n] in scores:
                for p, rest in paths(word[n:]):
                    yield p * scores[word[:n]], [word[:n], *rest]

    words, counts = [b"abcab", b"bb", b"cab"], np.array([2.0, 1.0, 5.0])
    want = Counter()
    for word, count in zip(words, counts):
        found = list(paths(word))
        for p, used in found:
            for piece in used:
                want[piece] += count * p / sum(q for q, _ in found)
    got = small.expected(words, np.stack([np.zeros(3), counts], axis=1))
    assert np.allclose(got[:, 1], [want[p] for p in small.pieces]) and not got[:, 0].any()


def test_subwords_spell_everything():
    pieces = lm.subwords(TOKENIZER)
    assert {bytes([c]) for c in range(256)} <= set(pieces) and len(set(pieces)) == len(pieces)


@pytest.mark.parametrize("head", [3, lm.HEAD])
def test_scores_of_edge_rows(edge_docs, edge_rows, head):
    got = {}
    for r in lm.score_texts(edge_docs, TOKENIZER, modulus=3, head=head).collect():
        got.setdefault(r["doc_id"], []).append(r)
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 3 == 0
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t, *_ in edge_rows]
    counts = Counter(w for i, ws in tokens if not fold(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        match = [r for r in got[i] if r["n_tokens"] == len(ws) and abs(r["base_score"] - base) < 1e-6]
        assert match, i
        assert all(r["held_out"] == fold(i) and r["train_tokens"] == n for r in match)
        assert all(r["n_known"] == sum(counts[w] > 0 for w in ws) for r in match)
        assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in match)


def test_head_and_tail_agree(edge_docs):
    few, many = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score_texts(edge_docs, TOKENIZER, head=h).collect()}
                 for h in (2, lm.HEAD))
    assert few.keys() == many.keys()
    assert all(few[k] == pytest.approx(many[k], abs=1e-9) for k in few)


def test_learning_helps(spark):
    from tests.llm.conftest import prose

    docs = spark.createDataFrame([(i, prose(200, i), "en") for i in range(120)], "doc_id long, text string, lang string")
    held = lm.score_texts(docs, TOKENIZER).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held["s"] > held["b"] * 1.02


def test_nothing_to_learn_from(spark, no_docs):
    assert lm.score_texts(no_docs, TOKENIZER).collect() == []
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(one, "some text"), (one, None)], "doc_id long, text string")
    for row in lm.score_texts(docs, TOKENIZER, kind=None).collect():
        assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0 and np.isfinite(row["score"])


def test_long_subwords_are_arcs():
    pieces = lm.subwords(TOKENIZER)
    long = [p for p in pieces if len(p) > 16]
    assert b"telecommunications" in long and len(set(pieces)) == len(pieces)
    lattice = lm.Lattice.of_ranks(TOKENIZER, 1)
    scores = dict(zip(lattice.pieces, np.exp(lattice.scores[:, 0])))
    for word in (b"telecommunications", b"=" * 20):
        sums = [1.0]
        for stop in range(1, len(word) + 1):
            sums.append(sum(sums[a] * scores.get(word[a:stop], 0.0) for a in range(stop)))
        assert lattice.log_marginals([word])[0, 0] == pytest.approx(np.log(sums[-1] * 0.3 / 0.7))
