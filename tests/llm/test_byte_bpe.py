from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from feedlens.llm import byte_bpe as bb
from feedlens.llm.common import RANKS
from feedlens.llm.queries import QUERIES

PARTS = [*"ab'stremvld  \n\t1２é日ʼ!?.\x1c\x85😀", "'re", "'ll", "'S", "<|endoftext|>", "　", "\U00010d50", "\U00010d41", "́"]


@pytest.fixture(scope="module")
def ranks():
    return bb.load_ranks(RANKS)


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bb.Encoder(ranks, bb.Automaton(), bb.Pairs(ranks))


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(7)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(50))) for _ in range(3000)]
    return [*made, "", " ", "'", "x" * 3000, "a" * 90 + " " * 300 + "b", "' " * 200, "".join(rng.choice("abcde") for _ in range(2000))]


def ids_of(encoder, texts):
    ids, ends, per_text = encoder.encode([t.encode() for t in texts])
    border = np.cumsum(per_text)[:-1]
    return [x.tolist() for x in np.split(ids, border)], [x.tolist() for x in np.split(ends, border)]


def test_ids_and_offsets_of_odd_texts(encoder, plain, ranks, odd_texts):
    ids, ends = ids_of(encoder, odd_texts)
    assert ids == [plain.encode_ordinary(t) for t in odd_texts]
    back = {rank: token for token, rank in ranks.items()}
    for text_ids, text_ends in zip(ids, ends):
        assert text_ends == np.cumsum([len(back[i]) for i in text_ids]).tolist()


def test_windows_hand_on_their_state(encoder, odd_texts):
    texts = [t.encode() for t in odd_texts]
    buffer = b"\n".join([*texts, b""])
    resets = np.cumsum([len(t) + 1 for t in texts]) - 1
    whole = encoder.automaton.token_starts(buffer, resets)
    for window in (1, 7, 1000):
        assert np.array_equal(encoder.automaton.token_starts(buffer, resets, window), whole)


def test_scan_equals_one_step_after_another(encoder):
    automaton, rng = encoder.automaton, np.random.default_rng(3)
    kinds = rng.integers(0, bb.CLASSES, 3 * bb.BLOCK * bb.BLOCK + 5)
    after, state = automaton.apply[automaton.prefixes(automaton.of_class[kinds]), bb.NEW], bb.NEW
    for kind, found in zip(kinds.tolist(), after.tolist()):
        state = bb._step(state, kind)[0]
        assert state == found


def test_slices_merge_alike_side_by_side_and_by_heap(encoder, ranks, plain, monkeypatch):
    rng = random.Random(5)
    pieces = ["".join(rng.choice("etaoinsh") for _ in range(n)) for n in (9, 9, 40, 63, 64, 65, 200) for _ in range(60)]
    expected = [plain.encode_ordinary(p) for p in pieces]
    assert [bb.merge(p.encode(), ranks) for p in pieces] == expected
    assert ids_of(encoder, pieces)[0] == expected
    monkeypatch.setattr(bb, "LONG", 3)
    assert [bb.merge(p.encode(), ranks) for p in pieces] == expected


def test_the_cache_may_be_emptied(ranks, plain, encoder, odd_texts, monkeypatch):
    monkeypatch.setattr(bb, "CACHED", 10)
    small = bb.Encoder(ranks, encoder.automaton, encoder.pairs)
    for low in range(0, 600, 50):
        part = odd_texts[low : low + 50]
        assert ids_of(small, part)[0] == [plain.encode_ordinary(t) for t in part]


def test_edge_rows(spark, edge_docs, edge_rows, no_docs, plain):
    encoded = bb.encode(edge_docs, RANKS)
    expected = sorted(((i, plain.encode_ordinary(t or "")) for i, t, *_ in edge_rows), key=str)
    assert sorted(((r["doc_id"], r["ids"]) for r in encoded.collect()), key=str) == expected
    for ends in ("ends", None):
        decoded = bb.decode(encoded, RANKS, ends=ends).collect()
        assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in decoded) == sorted((str(i), (t or "").encode()) for i, t, *_ in edge_rows)
    assert bb.encode(no_docs, RANKS).collect() == bb.round_trip(no_docs, RANKS).collect() == []


def test_decoding_other_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64, 220])], "doc_id int, ids array<int>")
    found = {r["doc_id"]: bytes(r["decoded"]) for r in bb.decode(rows, RANKS, ends=None).collect()}
    assert found == {1: b"", 2: b"", 3: b"a "}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bb.decode(spark.createDataFrame([(1, [1 << 30])], "doc_id int, ids array<int>"), RANKS, ends=None).collect()


def test_all_documents(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    digest = lambda data: hashlib.sha256(data).hexdigest()
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_byte_bpe"](spark, sf_dir).collect()}
    expected = {}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        text = row["text"] or ""
        ids = plain.encode_ordinary(text)
        expected[row["doc_id"]] = (len(ids), digest(" ".join(map(str, ids)).encode()), digest(text.encode()))
    assert found == expected
