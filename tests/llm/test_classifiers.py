from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from feedlens.llm import quality, toxicity
from feedlens.llm.labelled import known_labels
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(500):
        words = prose(rng.randint(30, 150), i).split()
        toxic, good = i % 5 == 0, i % 4 != 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
        text = " ".join(words)
        docs.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"))


def _measure(scored, labels, label, name, least):
    rows = scored.join(labels.where("quality is not null"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % (3 if label == "toxic" else 5) == (label == "toxic")]
    assert len(held) > 50
    right = sum((r[name] >= least) == bool(r[label]) for r in held)
    return right / len(held)


def test_toxicity_of_held_out_rows(labelled, edge_docs):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    assert _measure(toxicity.add_scores(docs, model, "score"), labels, "toxic", "score", 0.7) > 0.95
    got = toxicity.add_scores(edge_docs, model, "toxic")
    assert got.columns == [*edge_docs.columns, "toxic"] and got.count() == edge_docs.count()
    assert all(0 <= r["toxic"] <= 1 for r in got.collect())


def test_class_models_are_distributions(labelled):
    model = toxicity.train(*labelled)
    for c in (0, 1):
        assert model.unigrams[c].sum() == pytest.approx(1)
        first = model.pairs // (model.start + 1)
        kept = np.bincount(first, model.kept[c], model.start + 1)
        assert np.allclose(kept + model.backoffs[c], 1)
        assert (model.backoffs[c] > 0).all()


def test_quality_of_held_out_rows(labelled, edge_docs):
    docs, labels = labelled
    trees = quality.train(docs, labels)
    assert _measure(quality.add_scores(docs, trees, "score"), labels, "quality", "score", 0.3) > 0.95
    got = quality.add_scores(edge_docs, trees, "good")
    assert got.columns == [*edge_docs.columns, "good"] and got.count() == edge_docs.count()
    assert all(0 <= r["good"] <= 1 for r in got.collect())


def test_training_repeats(labelled):
    docs, labels = labelled
    once, again = quality.train(docs, labels), quality.train(docs.repartition(2), labels)
    assert (once.leaf == again.leaf).all() and (once.feature == again.feature).all()
    assert np.allclose(toxicity.train(docs, labels).weights, toxicity.train(docs.repartition(2), labels).weights)


def test_no_labels(labelled, edge_docs, no_docs):
    docs, labels = labelled
    for some, score in ((labels.where("toxic = 5"), 0.0), (labels.where("toxic = 0"), 0.0)):
        model = toxicity.train(docs, some)
        assert {r["s"] for r in toxicity.add_scores(edge_docs, model, "s").collect()} == {score}
    trees = quality.train(docs, labels.where("quality = 5"))
    assert {r["s"] for r in quality.add_scores(edge_docs, trees, "s").collect()} == {0.5}
    assert quality.add_scores(no_docs, trees, "s").collect() == []
    assert toxicity.add_scores(no_docs, model, "s").collect() == []


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < 0)).astype(float)
    trees = quality.fit_trees(x, y, trees=20, depth=3)

    def walk(tree, row, node=0):
        if node >= trees.feature.shape[1]:
            return trees.leaf[tree, node - trees.feature.shape[1]]
        right = row[trees.feature[tree, node]] > trees.threshold[tree, node]
        return walk(tree, row, 2 * node + 1 + int(right))

    want = [trees.base + sum(walk(t, row) for t in range(20)) for row in x[:50]]
    assert np.allclose(trees.margins(x[:50]), want)
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.95


def test_statistics():
    assert quality.statistics(b"") == [0.0] * len(quality.STATISTICS)
    found = dict(zip(quality.STATISTICS, quality.statistics(b"AB ab ab!\n1 2")))
    assert found["upper_share"] == pytest.approx(2 / 13) and found["distinct_lines"] == 1
    assert found["exclamation_share"] == pytest.approx(1 / 13) and found["distinct_words"] == 1


def test_classes_are_counted_without_a_sample(labelled, monkeypatch):
    docs, labels = labelled
    bounds, take = [], quality.sample_ids

    def sample_ids(labels, label, modulus, remainder, per_class, *more):
        bounds.append(per_class)
        return take(labels, label, modulus, remainder, per_class, *more)

    monkeypatch.setattr(quality, "sample_ids", sample_ids)
    quality.train(docs, labels, per_class=50)
    assert bounds == [50]


def test_known_labels_are_all_of_them(spark):
    rows = [(i, int(i % 3 == 0)) for i in range(300)] + [(3, 0), (None, 1), (4, None)]
    known = known_labels(spark.createDataFrame(rows, "doc_id long, quality int"), "quality", 5, 0)
    assert "TakeOrdered" not in known._jdf.queryExecution().toString()
    kept = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    want = {1: sum(i % 3 == 0 for i in kept), 0: sum(i % 3 > 0 for i in kept)}
    assert {r["target"]: r["count"] for r in known.groupBy("target").count().collect()} == want


def test_a_repeated_id_gives_one_row(spark):
    from feedlens.llm.labelled import sample_texts

    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(400)] + [(2, None), (2, "b"), (3, "c"), (None, "d")], "doc_id long, text string")
    ids = spark.createDataFrame([(1, 1), (2, 0), (4, 1)], "sample_id long, target int")
    found = sample_texts(docs.repartition(3), ids, "text").collect()
    assert sorted((r["doc_id"], r["target"]) for r in found) == [(1, 1), (2, 0)]
    assert {r["text"] for r in sample_texts(docs, ids, "text").collect()} == {r["text"] for r in found}


def test_other_name_of_the_id(labelled):
    docs, labels = labelled
    same = toxicity.train(docs, labels)
    renamed = toxicity.train(docs.withColumnRenamed("doc_id", "number"), labels.withColumnRenamed("doc_id", "number"), id_column="number")
    assert np.allclose(same.weights, renamed.weights)


def test_likelihoods_equal_plain_loops():
    """Counts and formulas of the two models from lists of words, by dictionaries alone."""
    import math
    from collections import Counter

    rng = np.random.default_rng(8)
    texts = [[list(rng.integers(0, 6 + c, rng.integers(1, 12))) for _ in range(40)] for c in (0, 1)]
    v, start = 7, 7
    counts = [Counter(), Counter()]
    for c in (0, 1):
        for t in texts[c]:
            counts[c].update(set(zip([start, *t], t)))
    pairs = sorted(set(counts[0]) | set(counts[1]))
    by_word = [[sum(n for (_, b), n in counts[c].items() if b == w) for w in range(v)] for c in (0, 1)]
    by_first = [[sum(n for (a, _), n in counts[c].items() if a == w) for w in range(v + 1)] for c in (0, 1)]
    contexts = [len({a for a, b in pairs if b == w}) for w in range(v)]
    model = toxicity.Model({}, np.array(by_word, float), np.array(by_first, float), np.array(contexts, float),
                           np.array([a * (v + 1) + b for a, b in pairs]), np.array([[counts[c][p] for p in pairs] for c in (0, 1)], float))

    def log_p(c, a, b):
        shared = (contexts[b] + 1) / (sum(contexts) + v)
        kept = [max(n - toxicity.WORD_DISCOUNT, 0) / sum(by_word[c]) for n in by_word[c]]
        unigram = kept[b] + (1 - sum(kept)) * shared
        of_a = {q: max(n - toxicity.PAIR_DISCOUNT, 0) / max(by_first[c][a], 1) for (p, q), n in counts[c].items() if p == a}
        return math.log(of_a.get(b, 0) + (1 - sum(of_a.values())) * unigram)

    asked = [[], [3], *texts[0][:10], *texts[1][:10], [6, 6, 6, 0]]
    ratio, marked, n = model.log_ratios([list(map(int, t)) for t in asked])
    for i, t in enumerate(asked):
        found = [log_p(1, a, b) - log_p(0, a, b) for a, b in set(zip([start, *t], t))]
        assert ratio[i] == pytest.approx(sum(found)) and n[i] == len(found)
        assert marked[i] == pytest.approx(sum(max(x - toxicity.MARKED, 0) for x in found))


def test_words_are_learnt_alike_at_every_size(spark):
    """Words of three toxic texts stay in the model however many ordinary texts stand beside them."""
    for n in (60, 4000):
        rows = [(i, "plain words of any text", 0) for i in range(n)] + [(10_000 + i, "rare venom here", 1) for i in range(24)]
        made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = toxicity.train(made, made.select("doc_id", "toxic"))
        assert b"venom" in model.ids


def test_pairs_that_differ_are_kept_first(spark):
    rows = [(i, " ".join(f"a{j} b{j}" for j in range(30)), i % 2) for i in range(400)]
    rows += [(1000 + i, "odd couple", 1) for i in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(made, made.select("doc_id", "toxic"), max_pairs=2)
    v = len(model.ids) + 1
    kept = {(int(k) // (v + 1), int(k) % (v + 1)) for k in model.pairs}
    assert (model.ids[b"odd"], model.ids[b"couple"]) in kept
