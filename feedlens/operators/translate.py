"""Translations, one per (from, to) language pair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.nested import add_translation, translation
from feedlens.operators.engines import BatchTextFn, run_on_distinct_texts
from feedlens.operators.joins import TEXT_KEY, with_text_key
from feedlens.operators.language import detect_language
from feedlens.operators.sizing import constant, rows_if_small

MAX_INLINE_LEXICON = 200


def language_pairs(from_lang: str | list[str], to_lang: str | list[str]) -> list[tuple[str, str]]:
    """The cross product of the languages; an equal pair is an error. "" asks for detection."""
    sources = [from_lang] if isinstance(from_lang, str) else list(from_lang)
    targets = [to_lang] if isinstance(to_lang, str) else list(to_lang)
    pairs = [(f, t) for f in sources for t in targets]
    if any(f == t for f, t in pairs):
        raise ValueError("original and target language of a translator must differ")
    return pairs


def _look_up_words(
    messages: DataFrame, lexicon: DataFrame, lang: str, to_lang: str, max_inline: int
) -> DataFrame:
    """Add ``_translated``: blank-separated words replaced where the lexicon has them."""
    table = (
        lexicon.where(F.col("to_lang") == to_lang)
        .groupBy(F.col("from_lang").alias("_lang"), F.lower("word").alias("_word"))
        .agg(F.min("translation").alias("_new"))
    )
    tokens = F.split(F.col("text"), " ")
    rows = rows_if_small(table, max_inline)
    if rows is not None:
        by_lang: dict[str, dict[str, str]] = {}
        for row in rows:
            by_lang.setdefault(row["_lang"], {})[row["_word"]] = row["_new"]
        out: Column = F.col("text")
        for code, entries in sorted(by_lang.items()):
            words = constant(entries, "map<string,string>")
            replaced = F.array_join(
                F.transform(tokens, lambda w: F.coalesce(F.try_element_at(words, F.lower(w)), w)), " "
            )
            out = F.when(F.col(lang) == code, replaced).otherwise(out)
        return messages.withColumn("_translated", out)

    keyed = with_text_key(messages, F.col("text"))
    hits = (
        keyed.select(*TEXT_KEY, F.col(lang).alias("_lang"),
                     F.explode(F.array_distinct(F.transform(tokens, F.lower))).alias("_word"))
        .join(table, ["_lang", "_word"])
        .groupBy(*TEXT_KEY, "_lang")
        .agg(F.map_from_entries(F.collect_set(F.struct("_word", "_new"))).alias("_hits"))
    )
    joined = keyed.join(hits.withColumnRenamed("_lang", lang), [*TEXT_KEY, lang], "left")
    replaced = F.array_join(
        F.transform(tokens, lambda w: F.coalesce(F.try_element_at("_hits", F.lower(w)), w)), " "
    )
    out = F.when(F.col("_hits").isNull(), F.col("text")).otherwise(replaced)
    return joined.withColumn("_translated", out).drop("_hits", *TEXT_KEY)


def translate_with_lexicon(
    messages: DataFrame,
    lexicon: DataFrame,
    from_lang: str | list[str],
    to_lang: str | list[str],
    stopwords: DataFrame | None = None,
    max_inline: int = MAX_INLINE_LEXICON,
) -> DataFrame:
    """Append word-by-word translations. A short lexicon needs no shuffle; for a
    long one the distinct words of each text are looked up in a join, and the text
    is rebuilt in its own row from the hits that come back.

    With ``from_lang=""`` the stop-word vote fills the source language, and a
    message of undetected language keeps its text. Null and empty texts pass
    through unchanged.
    """
    pairs = language_pairs(from_lang, to_lang)
    if any(f == "" for f, _ in pairs):
        if stopwords is None:
            raise ValueError("language detection needs a stop-word table")
        messages = detect_language(messages, stopwords, "_detected")
    for source, target in pairs:
        lang = F.coalesce("_detected", F.lit("")) if source == "" else F.lit(source)
        looked_up = _look_up_words(
            messages.withColumn("_from", lang), lexicon, "_from", target, max_inline
        )
        entry = translation(F.col("_translated"), F.col("_from"), F.lit(target))
        messages = looked_up.withColumn(
            "translations", add_translation(F.col("translations"), entry)
        ).drop("_from", "_translated")
    return messages.drop("_detected")


def translate_with_engine(
    messages: DataFrame,
    setup: Callable[[str, str], BatchTextFn],
    from_lang: str | list[str],
    to_lang: str | list[str],
    tries: int = 10,
    pause: float = 10.0,
    failed: str | None = None,
) -> DataFrame:
    """Append translations made by a Python engine, run once per distinct text.

    ``setup(from, to)`` is called in each task and returns the batch function,
    whose frame has ``text`` and, for an empty ``from``, the detected ``lang``.
    After ``tries`` failures a text stays as it is; the other texts of its batch
    are translated. ``failed`` names a column for how many pairs failed.
    """
    if failed is not None:
        messages = messages.withColumn(failed, F.lit(0))
    answer = T.StructType(
        [T.StructField("_new", T.StringType()), T.StructField("_lang", T.StringType())]
    )
    for source, target in language_pairs(from_lang, to_lang):

        def prepare(source: str = source, target: str = target) -> BatchTextFn:
            engine = setup(source, target)

            def run(texts):
                out = engine(texts).rename(columns={"text": "_new", "lang": "_lang"})
                return out if "_lang" in out else out.assign(_lang=None)

            return run

        done = run_on_distinct_texts(messages, prepare, answer, tries=tries, pause=pause, failed="_bad")
        if failed is not None:
            done = done.withColumn(failed, F.col(failed) + F.col("_bad").cast("int"))
        lang = F.coalesce("_lang", F.lit("")) if source == "" else F.lit(source)
        entry = translation(F.coalesce("_new", "text"), lang, F.lit(target))
        messages = done.withColumn("translations", add_translation(F.col("translations"), entry)).drop(
            "_new", "_lang", "_bad"
        )
    return messages
