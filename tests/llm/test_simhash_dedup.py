from __future__ import annotations

import numpy as np
import pytest
import xxhash

from feedlens.llm import components as cc
from feedlens.llm import simhash_dedup as sd
from feedlens.llm.components import components, forest


def _plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _united(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def _expected(rows):
    fps = [_plain_fingerprint(r[1]) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = _united(len(rows), near)
    least = {}
    for row, root in zip(rows, roots):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    return [(row[0], f"{fp:016x}", least.get(root)) for row, fp, root in zip(rows, fps, roots)]


def test_golay_code_is_perfect():
    code = sd.Golay()
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    index = code.own(words)
    assert index.max() < 4096
    rows, near = code.near(words)
    assert set(np.bincount(rows)) <= {1, 6}
    # every word within one bit has the word's own codeword among its near ones
    for bit in range(23):
        flipped, others = code.near(words ^ (1 << bit))
        met = np.zeros(len(words), bool)
        met[flipped[others == index[flipped]]] = True
        assert met.all()


def test_keys_meet_all_pairs_within_three_bits():
    rng = np.random.default_rng(2)
    code = sd.Golay()
    for bits in (1, 2, 3):
        x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
        flips = np.zeros(3000, np.uint64)
        for i in range(3000):
            for b in rng.choice(64, bits, replace=False):
                flips[i] |= np.uint64(1) << np.uint64(b)
        key, row = sd.own_keys(x.view(np.int64), code)
        other, of = sd.near_keys((x ^ flips).view(np.int64), code)
        have = set(zip(row.tolist(), key.tolist()))
        assert {r for r, k in zip(of.tolist(), other.tolist()) if (r, k) in have} == set(range(3000))


def test_groups_equal_brute_force(edge_docs, edge_rows):
    got = sd.near_duplicates(edge_docs)
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, _expected(edge_rows)))


def test_one_row_stays_of_each_group(edge_docs, edge_rows):
    got = sd.drop_near_duplicates(edge_docs)
    assert got.columns == edge_docs.columns
    want = {repr(i) for i, _, least in _expected(edge_rows) if i == least}
    assert sorted(repr(r["doc_id"]) for r in got.collect()) == sorted(want)


def test_chains_of_fingerprints(spark):
    rng = np.random.default_rng(3)
    fps = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 30)]
    for fp in list(fps):
        for step in range(6):  # each two bits from the one before
            fp ^= 3 << 2 * step
            fps.append(fp)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = sorted({tuple(sorted(r)) for r in sd.links(table).collect()})
    mask = (1 << 64) - 1
    near = {tuple(sorted((a, b))) for a in fps for b in fps if a != b and ((a ^ b) & mask).bit_count() <= 3}
    assert found == sorted(near)


def test_components_of_random_links(spark):
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, 500, (350, 2)).tolist() + [[i, i + 1] for i in range(600, 700)] + [[900, 900]]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "x long, y long").repartition(5)).collect()}
    roots = _united(1000, pairs)
    assert got == {i: r for i, r in enumerate(roots) if r != i}
    node, root = forest(*np.array(pairs).T)
    assert dict(zip(node.tolist(), root.tolist())) == got


@pytest.fixture
def plans(monkeypatch):
    """The plans of the tables written by an operator, as Spark first makes them."""
    made = []

    def kept(df, write=sd.cut_lineage):
        made.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(sd, "cut_lineage", kept)
    monkeypatch.setattr(cc, "cut_lineage", kept)
    return made


def test_links_are_not_broadcast(spark, tmp_path):
    # a written table counts as large as its files, its fifty keys a row do not count at all
    spark.range(1000).selectExpr("xxhash64(id) fp").write.parquet(str(tmp_path / "fps"))
    plan = sd.links(spark.read.parquet(str(tmp_path / "fps")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("operator, joins", [(sd.near_duplicates, 5), (sd.drop_near_duplicates, 6)])
def test_nothing_that_grows_is_broadcast(edge_docs, plans, operator, joins):
    sd.cut_lineage(operator(edge_docs))
    assert sum(plan.count("SortMergeJoin") for plan in plans) >= joins
    assert not any("Broadcast" in plan for plan in plans)


def test_minima_are_not_broadcast(spark, plans):
    components(spark.createDataFrame([[i, i + 1] for i in range(100)], "x long, y long").repartition(5))
    assert sum(plan.count("SortMergeJoin") for plan in plans) >= 2
    assert not any("Broadcast" in plan for plan in plans)


def test_empty(spark, no_docs):
    assert sd.near_duplicates(no_docs).collect() == []
    assert sd.drop_near_duplicates(no_docs).collect() == []
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []
