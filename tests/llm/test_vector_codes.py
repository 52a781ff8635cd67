from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from feedlens.llm import vector_codes as vc
from feedlens.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _of int, id int"


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) and the digest, by plain whole-number loops."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], None
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    whole = [[math.floor(256 * x) for x in np.array(r[1], float)] for r in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(part, book):
        far = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return min(range(len(far)), key=lambda i: (far[i], i)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = [[] for _ in books[p]]
            for c in cut:
                held[near(c[p], books[p])[0]].append(c[p])
            books[p] = [[sum(x) // len(h) for x in zip(*h)] if h else e for h, e in zip(held, books[p])]
    out = []
    for r, c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{i:02x}" for i, _ in found), sum(f for _, f in found), r[2]))
    of_label = {}
    for _, _, error, label in out:
        of_label[label] = of_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, of_label[label]) for i, c, e, label in out), key=str), digest


def check(df, rows):
    expected, digest = brute(rows)
    found = df.collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == expected
    assert {r["codebooks_sha256"] for r in found} <= {digest}


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 0.4, (30, 32))
    made = [(i, (centres[i % 30] + rng.normal(0, 0.03, 32)).astype(np.float32).tolist(), i % 4) for i in range(500)]
    made += [(600 + i, [0.25] * 32, None) for i in range(40)]  # copies, and a label of its own
    made += [(700, None, 1), (701, [], 1), (702, [None] + [0.0] * 31, 1), (703, [math.nan] * 32, 1), (704, [math.inf] * 32, 1),
             (705, [0.0] * 32, 1), (705, [0.0] * 32, 1), (3, [-0.5] * 32, 2), (None, [0.1] * 32, None), (706, [1000.0] * 32, 9),
             (707, [0.5] * 16, 1)]
    return made


def test_equals_plain_loops(spark, rows, monkeypatch):
    monkeypatch.setattr(vc, "CHUNK_ROWS", 128)
    monkeypatch.setattr(vc, "LEAF", 8)
    check(vc.compress(frame(spark, rows)), rows)


def test_few_and_none(spark, rows):
    for some in (rows[:5], rows[500:512], rows[540:545], []):
        check(vc.compress(frame(spark, some)), some)


def test_refused_vectors(spark):
    with pytest.raises(ValueError, match="equal parts"):
        vc.compress(frame(spark, [(1, [0.5] * 17, 1)]))
    with pytest.raises(ValueError, match="not below"):
        vc.compress(frame(spark, [(1, [2.0**21] * 16, 1)]))


@pytest.mark.parametrize("leaf", [1, 8, 64])
def test_trees(leaf, monkeypatch):
    monkeypatch.setattr(vc, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    for n, width, spread in ((1, 4, 5), (700, 4, 3), (900, 4, 200), (400, 1, 4000), (300, 9, 1 << 26)):
        points = rng.integers(-spread, spread, (n, width))
        tree = vc.Tree.of(points)
        assert (tree.points[tree.place] == points).all() and tree.weight.sum() == n
        for low, high, (one, two), center, radius in zip(tree.low, tree.high, tree.child, tree.center, tree.radius):
            assert np.sqrt(((tree.points[low:high] - center) ** 2).sum(axis=1)).max() <= radius * (1 + 1e-9) + 1e-9
            if one >= 0:
                assert (tree.low[one], tree.high[one], tree.high[two]) == (low, tree.low[two], high)
        assert len(tree.low) == 1 or (tree.high - tree.low)[tree.child[:, 0] < 0].max() <= max(leaf, 1)
        book = points[rng.integers(0, n, min(n, 64))]  # with equal entries
        at, far = vc.nearest(points, book)
        code, error = tree.codes(book)
        assert (code == at).all() and (error == far).all()
        sums, counts = tree.totals(book)
        assert (counts == np.bincount(at, minlength=len(book))).all()
        plain = np.zeros_like(sums)
        np.add.at(plain, at, points)
        assert (sums == plain).all()


def test_balls_are_wholly_owned():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (20, 4))
    points = np.concatenate([c + rng.integers(-20, 20, (300, 4)) for c in centres])
    tree = vc.Tree.of(points)
    asked = sum(len(at) for at, _, is_ball in tree.owned(centres) if not is_ball)
    assert asked < len(points) / 20


def test_all_embeddings(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    check(QUERIES["op13_vector_codes"](spark, sf_dir), rows)
