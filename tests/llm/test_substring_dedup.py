from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from feedlens.llm import bloom, substring_dedup
from feedlens.llm.fm_index import FMIndex, WaveletMatrix, suffix_array


def _expected(rows, window):
    texts = [(t or "").encode().split() for _, t, *_ in rows]
    age = [(-(1 << 63) if r[0] is None else r[0]) for r in rows]
    first: dict = {}
    for a, words in zip(age, texts):
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            first[key] = min(first.get(key, (a, s)), (a, s))
    out = []
    for row, a, words in zip(rows, age, texts):
        cut = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < (a, s):
                cut[s:s + window] = [True] * window
        kept = b" ".join(w for w, c in zip(words, cut) if not c)
        out.append((row[0], len(words), sum(cut), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def _got(docs, **settings):
    rows = substring_dedup.remove_repeats(docs, **settings).collect()
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in rows)
    return sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in rows)


@pytest.mark.parametrize("max_bytes", [bloom.MAX_BYTES, 1])
def test_edge_rows_equal_brute_force(edge_docs, edge_rows, max_bytes):
    assert _got(edge_docs, max_bytes=max_bytes) == _expected(edge_rows, 20)


@pytest.mark.parametrize("seed", [0, 1])
def test_random_passages_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abc") for _ in range(rng.randint(3, 30))] for _ in range(12)]
    rows = []
    for i in range(80):
        words = [w for _ in range(rng.randint(0, 6)) for w in rng.choice(passages) + [rng.choice("abcdefgh")]]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _got(docs, window=6, anchor=3) == _expected(rows, 6)


def test_empty(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []


def test_suffix_array_and_ranks():
    rng = np.random.default_rng(7)
    for n in (1, 2, 50, 400):
        text = rng.integers(0, 4, n)
        assert suffix_array(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
        matrix = WaveletMatrix(text, 4)
        at = np.arange(n + 1)
        for symbol in range(4):
            want = np.concatenate([[0], np.cumsum(text == symbol)])
            assert matrix.rank(np.full(n + 1, symbol), at).tolist() == want.tolist()


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(8)
    for depth in (1, 3, 20):
        text = rng.integers(0, 3, 200)
        index = FMIndex(text, 5, depth)
        queries = [rng.integers(-1, 4, n) for n in (1, 30, 80)] + [text[40:90]]
        lengths = np.array([len(q) for q in queries])
        starts = np.cumsum(lengths) - lengths
        match, row = index.matching_statistics(np.concatenate(queries), starts, lengths)
        whole = text.tolist()
        for q, s in zip(queries, starts):
            for i in range(len(q)):
                best = 0
                while best < min(depth, len(q) - i) and any(
                    whole[p:p + best + 1] == q[i:i + best + 1].tolist() for p in range(200 - best)
                ):
                    best += 1
                assert match[s + i] == best
                if best == depth:
                    here = index.first[index.class_of[row[s + i]]]
                    assert here == next(p for p in range(200) if whole[p:p + depth] == q[i:i + depth].tolist())
