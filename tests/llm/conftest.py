from __future__ import annotations

import random

import pytest

EXTRA = "digest string, maybe boolean, fp long, place int, keep_id long, score double, word string, held string, copies int, size long, text_hash long"


def prose(n: int, seed: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(words * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, ties, repeated rows, odd characters."""
    base, other = prose(60, 1), prose(60, 2)
    near = base.split()
    near[30] = "changed"
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), None, None),
        (4, None, "en", "b"), (5, "", None, "b"), (6, " \t\n ", "de", "b"), (None, other, "de", None),
        (None, None, None, None), (7, "one", "en", "a"), (8, "two words", "en", "a"), (9, prose(3000, 3), "fr", "ä"),
        (10, other + "\n\n" + base, "en", "A"), (11, " ".join(near), "en", "a"), (12, "x" * 5000, "en", "c"),
        (13, "ÄÖÜ É ß   日本 <|endoftext|> \U0001f600", "de", "c"), (14, "a " * 200, "en", "c"),
        (15, prose(40, 5) + " " + prose(40, 5), "en", "c"), (16, other, "en", "d"), (17, "ÉCOLE", "fr", "d"),
        (18, "École", "fr", "d"), (19, prose(500, 9), "en", "d"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string").repartition(3)
    for field in EXTRA.split(", "):
        name, kind = field.split()
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
