from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from feedlens.llm import spelling as sp
from feedlens.llm.queries import QUERIES


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts: dict[str, int], factor: int = 10) -> dict[str, tuple]:
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts.get(form[w]), root)
    return out


def words_of(rows) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def result(df) -> dict[str, tuple]:
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


@pytest.fixture(scope="module")
def made_counts():
    """Words thick with near ones: few letters, accents, chains of forms, ties."""
    rng = random.Random(4)
    counts = {"".join(rng.choice("eaé×z") for _ in range(rng.choice([7, 7, 8]))): rng.choice([2, 2, 3, 20, 300, 4000]) for _ in range(700)}
    counts |= {"n" * 500: 50, "n" * 501: 5, "n" * 499 + "m": 4, "ÿ" * 7: 2, "ÿ" * 8: 20, "ÿ" * 9: 200, "ÿ" * 10: 2000}
    return counts


@pytest.mark.parametrize("most", [sp.SHARD, 20])
def test_made_words(spark, made_counts, most, monkeypatch):
    if most < sp.SHARD:  # shards that the deepest cut leaves too large are split by hash
        monkeypatch.setattr(sp, "DEEPEST", 3)
    words = spark.createDataFrame(list(made_counts.items()), "word string, n long").repartition(3)
    depth, parts = sp._deep_enough(words, most)
    assert (parts > 1) == (most < sp.SHARD)
    assert result(sp.variants(words, most=most)) == brute(made_counts)


def test_pairs_are_found_once_whatever_the_leaves(made_counts, monkeypatch):
    import numpy as np

    names = sorted(made_counts)
    expected = {frozenset((a, b)) for i, a in enumerate(names) for b in names[i + 1 :] if one_edit(a, b)}
    for leaf, pairs in ((1, 7), (24, 1 << 18), (10_000, 1000)):
        monkeypatch.setattr(sp, "LEAF", leaf)
        monkeypatch.setattr(sp, "PAIRS", pairs)
        trie = sp.Trie(sp.Words(names), np.arange(len(names)))
        found = [frozenset((names[i], names[j])) for a, b in trie.near(np.arange(len(names))) for i, j in zip(a, b)]
        assert len(found) == len(set(found)) and set(found) == expected


def test_a_word_meets_each_near_word_in_one_shard(made_counts):
    names = sorted(made_counts)
    words = sp.Words(names)
    for depth in (1, 4, sp.LEVELS):
        home = sp.shard_keys(words, depth)
        seen = [set() for _ in names]
        for i, key in enumerate(home):
            seen[i].add(key)
        for rows, keys in sp.searched(words, depth):
            for i, key in zip(rows, keys):
                seen[i].add(key)
        for i, a in enumerate(names):
            for j in range(i):
                if one_edit(a, names[j]):
                    assert home[i] in seen[j] or home[j] in seen[i]


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["Abertura", "aberturas", "abertur", "École12naturelle", "x" * 3000, "ÀÿÀÿÀÿÀ"]) for _ in range(90)) for _ in range(40)]
    more = [(100 + i, t, None, None) for i, t in enumerate(texts)]
    made = spark.createDataFrame(more, "doc_id long, text string, lang string, source string")
    docs = edge_docs.select("doc_id", "text", "word", "score").unionByName(made.select("doc_id", "text"), allowMissingColumns=True)
    expected = brute(words_of([(r[0], r[1]) for r in [*edge_rows, *more]]))
    assert len(expected) > 8 and any(v[2] for v in expected.values())
    assert result(sp.group_variants(docs)) == expected
    assert sp.group_variants(no_docs).collect() == []


def test_tasks_hand_on_their_counts(spark, edge_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(sp, "HELD_WORDS", 2)
    found = {r["word"]: r["n"] for r in sp.count_words(edge_docs).collect()}
    assert found == words_of([(r[0], r[1]) for r in edge_rows])


def test_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    counts = words_of(rows)
    found = result(QUERIES["op12_spelling_trie"](spark, sf_dir))
    assert {w: v[0] for w, v in found.items()} == counts
    near: dict[str, set] = {w: set() for w in counts}
    by_rest: dict[tuple, list] = {}
    for w in counts:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
            by_rest.setdefault((i, rest), []).append(w)
    for group in by_rest.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    assert {w: v[1] for w, v in found.items()} == {w: len(v) for w, v in near.items()}
