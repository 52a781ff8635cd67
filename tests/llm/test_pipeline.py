"""The pipeline, stage by stage, against plain versions on each stage's own input."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from feedlens.llm import mixing, simhash_dedup, toxicity
from feedlens.llm.common import TOKENIZER, batches, table
from feedlens.session import cut_lineage
from tests.llm.test_packing import _check
from tests.llm.test_simhash_dedup import _united

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of every stage."""
    docs = table(batches(spark), DATA, "documents")
    out = {}
    for name, stage in pipeline.STAGES:
        made = cut_lineage(stage(spark, docs, DATA))
        out[name] = (docs, made)
        docs = made
    return out


def _ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_are_those_of_documents(stages):
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_dedup", "mix_sources", "pack"]
    for name in names[:-1]:
        assert stages[name][1].columns == stages["toxicity"][0].columns


def test_toxicity(spark, stages):
    given, kept = stages["toxicity"]
    model = toxicity.train(given, table(spark, DATA, "labels"), modulus=3, remainder=1)
    rows = given.select("doc_id", "text").collect()
    scores = model.scores([(r["text"] or "").encode() for r in rows])
    assert _ids(kept) == Counter(r["doc_id"] for r, s in zip(rows, scores) if s < 0.7)
    assert 0.5 * given.count() < kept.count() < given.count()


def test_exact_dedup(stages):
    given, kept = stages["exact_dedup"]
    best: dict = {}
    for r in given.collect():
        key = (r["text"] or "").encode().lower()
        best[key] = max(best.get(key, r["doc_id"]), r["doc_id"])
    assert _ids(kept) == Counter(best.values())


def test_simhash_dedup(stages):
    given, kept = stages["simhash_dedup"]
    rows = given.collect()
    fps = [simhash_dedup.fingerprint((r["text"] or "").encode()) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    groups = defaultdict(list)
    for row, root in zip(rows, _united(len(rows), near)):
        groups[root].append(row["doc_id"])
    assert _ids(kept) == Counter(map(min, groups.values()))


def test_mix_sources(stages):
    given, mixed = stages["mix_sources"]
    db = duckdb.connect()
    documents = given.select("doc_id", "text", "source").toPandas()  # noqa: F841
    db.register("documents", documents)
    want = db.execute(mixing.ORACLE_SQL).fetchdf()
    have = _ids(mixed)
    for doc_id, size, taken in want[["doc_id", "size", "taken"]].itertuples(index=False):
        if size:
            assert have[doc_id] == (2 * taken + size) // (2 * size), doc_id
        assert have[doc_id] <= 2
    texts = {r["doc_id"]: tuple(r) for r in given.collect()}
    assert all(texts[r["doc_id"]] == tuple(r) for r in mixed.collect())


def test_pack(stages):
    given, packed = stages["pack"]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    _check(packed.collect(), [r["text"] for r in given.collect()], tokenizer, 1024)


def test_run_applies_the_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ran = Counter(map(tuple, pipeline.run(spark, DATA).select(columns).collect()))
    assert ran == Counter(map(tuple, stages["pack"][1].select(columns).collect()))


def test_stages_take_any_rows(spark, edge_docs, tmp_path):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (edge_docs, edge_docs.limit(0)):
        for name, stage in pipeline.STAGES:
            made = cut_lineage(stage(spark, docs, str(tmp_path)))
            assert name == "pack" or made.columns == docs.columns
            docs = made
        assert docs.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] >= docs.count()
