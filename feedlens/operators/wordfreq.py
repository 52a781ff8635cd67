"""Word frequencies.

Words are counted before anything is joined, so the lookups see each distinct
word once and not every occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import drop_trailing_dot, is_numeric, words


def word_counts(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Occurrences of each raw word, optionally per group."""
    by = list(by or [])
    return (
        messages.select(*by, F.explode(words(F.col("text"))).alias("word"))
        .groupBy(*by, "word")
        .agg(F.count("*").alias("frequency"))
    )


def lemmatize(counted: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Add ``lemma``: the lemma of the word, or the word itself."""
    table = lemmas.groupBy("word").agg(F.min("lemma").alias("lemma"))
    return counted.join(table, "word", "left").withColumn("lemma", F.coalesce("lemma", "word"))


def word_frequency(
    messages: DataFrame,
    stopwords: DataFrame,
    lemmas: DataFrame | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """``(by…, word, frequency)`` without stop words and numbers."""
    by = list(by or [])
    counted = word_counts(messages, by)
    if lemmas is not None:
        counted = lemmatize(counted, lemmas).drop("word").withColumnRenamed("lemma", "word")
    stop = stopwords.select("word").distinct()
    kept = counted.join(stop, "word", "left_anti").where(~is_numeric(F.col("word")))
    if lemmas is None:
        return kept.select(*by, "word", "frequency")
    # words of one lemma come together; only a lemma can bring a dot back
    return (
        kept.withColumn("word", drop_trailing_dot(F.col("word")))
        .groupBy(*by, "word")
        .agg(F.sum("frequency").alias("frequency"))
    )


def most_frequent(frequencies: DataFrame, n: int | None = None) -> DataFrame:
    """By frequency descending, equal ones by word; the first ``n`` when asked for."""
    ordered = frequencies.orderBy(F.col("frequency").desc(), F.col("word").asc())
    return ordered if n is None else ordered.limit(n)


def translate_words(frequencies: DataFrame, lexicon: DataFrame, from_lang: str, to_lang: str) -> DataFrame:
    """Add ``translation``; a word the lexicon lacks is kept as it is."""
    pair = (F.col("from_lang") == from_lang) & (F.col("to_lang") == to_lang)
    table = lexicon.where(pair).groupBy("word").agg(F.min("translation").alias("translation"))
    return frequencies.join(table, "word", "left").withColumn(
        "translation", F.coalesce("translation", "word")
    )
