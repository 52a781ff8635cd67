from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from feedlens.llm import packing
from feedlens.llm.common import TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(TOKENIZER)
    made.encode_special_tokens = True
    return made


def _check(got, rows, tokenizer, capacity):
    want = []
    for text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        head = (len(ids) - 1) % capacity + 1
        starts = [0, *range(head, len(ids), capacity)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    ends: dict = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values(), default=0) <= capacity
    return ends


@pytest.mark.parametrize("capacity", [16, 64, 1024])
def test_pieces_and_sequences(edge_docs, edge_rows, tokenizer, capacity):
    got = packing.pack(edge_docs, TOKENIZER, capacity=capacity).collect()
    ends = _check(got, [r[1] for r in edge_rows], tokenizer, capacity)
    assert len(ends) <= math.ceil(sum(ends.values()) / capacity) + 2


def test_fullest_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        items = rng.integers(1, 20, rng.integers(0, 8)).tolist()
        counts = np.bincount(items, minlength=41)
        room = int(rng.integers(0, 40))
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k) if (s := sum(c)) <= room)
        found = packing.fullest(counts, room)
        assert sum(found) == best
        assert (np.bincount(found, minlength=41) <= counts).all()


def test_plan_uses_every_piece_once_and_is_near_the_bound():
    rng = np.random.default_rng(6)
    counts = np.bincount(rng.integers(1, 1024, 20_000), minlength=1025)
    plan = packing.minimum_bin_slack(counts)
    used = np.zeros(1025, np.int64)
    for items, times in plan:
        assert sum(items) <= 1024
        np.add.at(used, items, times)
    assert (used == counts).all()
    assert sum(t for _, t in plan) <= 1.002 * (counts * np.arange(1025)).sum() / 1024 + 1


def test_ids_of_the_fast_library(tokenizer):
    encode = packing.encoder(TOKENIZER)
    for text in ("", " ", "\n\n \t x", "it's  WE'LL 12345 ,.;", "ñandú 東京 \U0001f600 é", "a" * 3000, " " * 3000,
                 "<|endoftext|>", "x y z", "\r\n" * 50, "0" * 200 + "é" * 200):
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty(no_docs):
    assert packing.pack(no_docs, TOKENIZER).collect() == []


def test_ids_of_a_whole_table(spark, tokenizer):
    encode = packing.encoder(TOKENIZER)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert encode(row["text"] or "") == tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
