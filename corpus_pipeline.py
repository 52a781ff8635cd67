"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept, which is read back from Parquet; all but the last return the columns of
``docs``. What each stage does with nulls, empty texts, ties and repeated rows
is stated in the module of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import exact_dedup, mixing, packing, simhash_dedup, toxicity
from feedlens.llm.common import TOKENIZER, batches, table, unused
from feedlens.session import cut_lineage

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score reaches ``TOXIC_FROM``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), modulus=3, remainder=1)
    score = unused(docs, "score")
    return toxicity.add_scores(docs, model, score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits), that with the smallest id."""
    return simhash_dedup.drop_near_duplicates(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum over the sources: 150% of all words, a document at most twice, in training order."""
    return mixing.mix(docs, share=1.5, max_repeats=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER, capacity=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: models, fingerprints and token ids are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    docs = table(batches(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
