"""The operators as queries over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import byte_bpe, exact_dedup, lattice_lm, mixing, packing, quality, rp_forest, simhash_dedup, spelling, substring_dedup, toxicity, vector_codes, warc_derivatives
from feedlens.llm.common import RANKS, TOKENIZER, batches, table
from feedlens.llm.labelled import held_out
from feedlens.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(batches(tune(spark)), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the whole corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


@query
def op1_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a curriculum of 150% of all words takes of each document."""
    mixed = mixing.assign(table(spark, sf_dir, "documents"), share=1.5, max_repeats=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op1_mix_curriculum"] = mixing.ORACLE_SQL


@query
def op2_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marginal log10 probability of every document over all segmentations of its words."""
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"), TOKENIZER, modulus=10, remainder=0)


@query
def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of all pages, blocks by their digest and length."""
    derived = warc_derivatives.derive(warc_derivatives.responses(table(spark, sf_dir, "pages")))
    return derived.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_type", "block_digest",
        "payload_digest", F.octet_length("block").cast("long").alias("content_length"),
        F.sha2("headers", 256).alias("headers_sha256"),
    )


@query
def op4_substring_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 20-word windows that occur earlier."""
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20, texts=False)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op4_substring_fm_index"] = substring_dedup.ORACLE_SQL


@query
def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, at most 3 bits apart."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query
def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; one fold of the labels is never learnt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.train(docs, table(spark, sf_dir, "labels"), modulus=5, remainder=0)
    return quality.add_scores(docs, trees, "score").select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op7_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document; one fold of the labels is never learnt."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), modulus=3, remainder=1)
    return toxicity.add_scores(docs, model, "score").select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept row of every group of equal texts, for all documents."""
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h,
         row_number() OVER () AS r
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY doc_id DESC NULLS LAST, r DESC)
"""


@query
def op9_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings with a cosine of at least 0.9, and their components."""
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query
def op10_pack_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2)


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document, and of what they decode to."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), RANKS)


@query
def op12_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their number of near words, their form and its root."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_trie"] = spelling.ORACLE_SQL


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every embedding, 16 parts of 64 entries each, with its errors."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


ORACLES["op13_vector_codes"] = vector_codes.ORACLE_SQL
