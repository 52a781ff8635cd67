"""Expressions over the nested message parts. None of them needs a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.schema import CLASSIFICATION


def translation(text: Column, from_lang: Column, to_lang: Column) -> Column:
    return F.struct(
        text.cast("string").alias("text"),
        from_lang.cast("string").alias("from_lang"),
        to_lang.cast("string").alias("to_lang"),
    )


def classification(topic: Column, score: Column, agent: Column) -> Column:
    return F.struct(
        topic.cast("string").alias("topic"),
        score.cast("double").alias("score"),
        agent.cast("string").alias("agent"),
    )


def add_translation(translations: Column, new: Column) -> Column:
    """Append, also when the language pair is already there."""
    return F.array_append(translations, new)


def set_translation(translations: Column, new: Column) -> Column:
    """Replace the text of every entry with the same language pair, else append."""

    def same_pair(old: Column) -> Column:
        return old["from_lang"].eqNullSafe(new["from_lang"]) & old["to_lang"].eqNullSafe(
            new["to_lang"]
        )

    replaced = F.transform(
        translations,
        lambda old: F.when(
            same_pair(old), translation(new["text"], old["from_lang"], old["to_lang"])
        ).otherwise(old),
    )
    return F.when(F.exists(translations, same_pair), replaced).otherwise(
        F.array_append(translations, new)
    )


def add_classifications(classifications: Column, new: Column) -> Column:
    return F.concat(classifications, new)


def add_locations(info: Column, new: Column) -> Column:
    """``info`` with the new locations behind the old ones."""
    old = F.coalesce(info["locations"], F.array().cast("array<struct<name:string,longitude:double,latitude:double>>"))
    return info.withField("locations", F.concat(old, new))


def translation_for(translations: Column, lang: str) -> Column:
    """The first translation into ``lang``; null when there is none."""
    return F.get(F.filter(translations, lambda t: t["to_lang"] == lang), 0)


def first_translation(translations: Column, field: str) -> Column:
    """A field of the first translation, or an empty string."""
    return F.coalesce(F.get(translations, 0)[field], F.lit(""))


def top_model_classification(classifications: Column) -> Column:
    """The highest-scoring entry of agent ``model``; the first one wins a tie."""
    by_model = F.filter(classifications, lambda c: c["agent"] == "model")
    none = F.lit(None).cast(CLASSIFICATION)

    def better(best: Column, c: Column) -> Column:
        return F.when(best.isNull() | (c["score"] > best["score"]), c).otherwise(best)

    return F.aggregate(by_model, none, better)


def with_complement(label: Column, other: Column, score: Column) -> Column:
    """Two model entries: the winning label and its opposite with ``1 - score``."""
    agent = F.lit("model")
    return F.array(
        classification(label, score, agent),
        classification(other, F.lit(1.0) - score, agent),
    )
