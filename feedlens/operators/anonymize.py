"""Anonymisation of the text or of one translation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.nested import set_translation, translation, translation_for
from feedlens.functions.redact import redact
from feedlens.functions.text import WORD, fold
from feedlens.operators.contains import contains_join
from feedlens.operators.engines import BatchTextFn, run_on_distinct_texts
from feedlens.operators.joins import TEXT_KEY, with_text_key


def anonymize(
    messages: DataFrame, lang: str | None = None, rewrite: Callable[[Column], Column] = redact
) -> DataFrame:
    """Rewrite the text; with ``lang``, the translation into it, or the text where none exists."""
    if lang is None:
        return messages.withColumn("text", rewrite(F.col("text")))
    old = translation_for(F.col("translations"), lang)
    new = translation(rewrite(old["text"]), old["from_lang"], old["to_lang"])
    return (
        messages.withColumn("text", F.when(old.isNull(), rewrite(F.col("text"))).otherwise(F.col("text")))
        .withColumn(
            "translations",
            F.when(old.isNotNull(), set_translation(F.col("translations"), new)).otherwise(F.col("translations")),
        )
    )


def redact_names(messages: DataFrame, names: DataFrame, placeholder: str = "[name]") -> DataFrame:
    """The text with every name of ``names(name)`` replaced where it stands as a whole word, in any case.

    Names meet the texts in the containment join, so the list may be long; a longer
    name is replaced before a shorter one that is part of it.
    """
    keyed = with_text_key(messages, F.col("text"))
    texts = keyed.select(*TEXT_KEY, F.lower("text").alias("_lower"))
    wanted = names.select(fold(F.col("name")).alias("_name")).where("_name <> ''").distinct()
    hits = contains_join(texts, "_lower", wanted, "_name").groupBy(*TEXT_KEY).agg(
        F.collect_set(F.struct((-F.length("_name")).alias("short"), F.col("_name").alias("name"))).alias("_hits")
    )

    def replace(text: Column, hit: Column) -> Column:
        quoted = F.regexp_replace(hit["name"], r"([\\.\[\]{}()*+\-?^$|&~#])", r"\\$1")
        return F.regexp_replace(
            text, F.concat(F.lit(rf"(?iu)(?<![{WORD}])"), quoted, F.lit(rf"(?![{WORD}])")), F.lit(placeholder)
        )

    joined = keyed.join(hits, TEXT_KEY, "left")
    replaced = F.aggregate(F.array_sort("_hits"), F.col("text"), replace)
    return joined.withColumn("text", F.coalesce(replaced, "text")).drop("_hits", *TEXT_KEY)


def anonymize_with_engine(
    messages: DataFrame, setup: Callable[[], BatchTextFn], tries: int = 10, pause: float = 10.0,
    failed: str = "anonymization_failed",
) -> DataFrame:
    """The text as rewritten by a Python engine (frame column ``text``), unchanged on failure.

    A text that the engine could not take keeps its personal data: the column
    ``failed`` says so for each message. Only such texts fail, not their batch.
    """
    answer = T.StructType([T.StructField("_new", T.StringType())])

    def prepare() -> BatchTextFn:
        engine = setup()
        return lambda texts: engine(texts).rename(columns={"text": "_new"})

    done = run_on_distinct_texts(messages, prepare, answer, tries=tries, pause=pause, failed=failed)
    return done.withColumn("text", F.coalesce("_new", "text")).drop("_new")
