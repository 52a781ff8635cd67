from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from feedlens.llm import bloom, exact_dedup


def _normal(text):
    return (text or "").encode().lower()


def _expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[_normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text).hexdigest()
        kept = ids.index(best)
        out += [(i, best, len(ids), n == kept, sha) for n, i in enumerate(ids)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("max_bytes", [bloom.MAX_BYTES, 1])
def test_groups_equal_brute_force(edge_docs, edge_rows, max_bytes):
    got = exact_dedup.duplicate_groups(edge_docs, max_bytes=max_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == _expected(edge_rows)


def test_one_whole_row_stays_of_each_text(edge_docs, edge_rows):
    got = exact_dedup.drop_copies(edge_docs)
    assert got.columns == edge_docs.columns
    want = sorted(repr((r[1], r[4])) for r in map(eval, _expected(edge_rows)) if r[3])
    have = sorted(repr((r["doc_id"], hashlib.sha256(_normal(r["text"])).hexdigest())) for r in got.collect())
    assert have == want


def test_many_values_in_a_full_filter(spark):
    from pyspark.sql import functions as F

    docs = spark.range(0, 60_000, 1, 5).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 50_000)).alias("text")
    )
    for max_bytes in (bloom.MAX_BYTES, 1):
        got = exact_dedup.duplicate_groups(docs, max_bytes=max_bytes)
        assert got.where("kept").count() == 50_000
        assert got.where("group_size = 2 and keep_id = 50000 + doc_id % 50000").count() == 20_000


def test_empty(no_docs):
    assert exact_dedup.duplicate_groups(no_docs).collect() == []
    assert exact_dedup.drop_copies(no_docs).collect() == []


def test_plane_reports_every_repeat_and_few_others():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    bits = bloom.plane_bits(len(values))
    planes = bloom.Planes(bits)
    for part in np.array_split(np.concatenate([values, values[:500]]), 7):
        planes.add(part)
    assert bloom.contains(planes.twice, values[:500]).all()
    assert bloom.contains(planes.twice, values[500:]).mean() < 0.01


def test_blocks_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for share in (0, 0.001, 0.06, 0.5, 1):
        block = np.packbits(rng.random(bloom.BLOCK_BITS) < share)
        packed = bloom._packed(block)
        assert len(packed) <= bloom.BLOCK_BYTES and (bloom._bits(packed) == block).all()
