"""How often the words of each class occur in a message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import listed_words, words
from feedlens.operators.contains import contains_join
from feedlens.operators.joins import TEXT_KEY, with_text_key
from feedlens.operators.sizing import MAX_INLINE_ROWS, rows_if_small

MESSAGE_KEY = ["source", "group", "id_"]
VOTES = "array<struct<label:string,n:bigint>>"


def class_votes(
    messages: DataFrame,
    table: DataFrame,
    label: str,
    text: Column,
    column: str = "_votes",
    distinct: bool = False,
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """Add ``column``: for each label of ``table(label, word)`` found, its number of hits.

    ``distinct`` counts each word once. A short table is folded into an expression:
    nothing is shuffled. A long one is joined to the words of each text, and hits
    are summed up by text and label before anything is exchanged; a text's copies
    share what was counted in all of them, so both ways give the same votes.
    """
    pairs = vote_terms(table, label)
    rows = rows_if_small(pairs, max_inline)
    with_words = messages.withColumn("_words", F.coalesce(words(text), F.array().cast("array<string>")))
    if rows is not None:
        listed: dict[str, list[str]] = {}
        for row in rows:
            listed.setdefault(row["label"], []).append(row["word"])
        counted = []
        for name in sorted(listed):
            single = sorted(w for w in listed[name] if " " not in w)
            if distinct:
                n = F.size(F.array_intersect(F.col("_words"), F.lit(single))) if single else F.lit(0)
            else:
                n = F.size(F.filter("_words", lambda w: w.isin(single))) if single else F.lit(0)
            for phrase in sorted(w for w in listed[name] if " " in w):
                uses = _uses(F.lit(phrase))
                n = n + (F.least(uses, F.lit(1)) if distinct else uses)
            counted.append(F.struct(F.lit(name).alias("label"), n.cast("bigint").alias("n")))
        if not counted:
            return messages.withColumn(column, F.array().cast(VOTES))
        every = sorted({row["word"] for row in rows})
        if all(" " not in word for word in every):  # only listed words are counted: keep no others
            found = F.coalesce(listed_words(text, every), F.array().cast("array<string>"))
            with_words = messages.withColumn("_words", found)
        votes = F.filter(F.array(*counted).cast(VOTES), lambda v: v["n"] > 0)
        return with_words.withColumn(column, votes).drop("_words")

    keyed = with_text_key(with_words, text)
    single, several = (pairs.where(F.contains(F.col("word"), F.lit(" ")) == c) for c in (False, True))
    # each message adds an empty word, which no term is: so the copies of its text are counted along
    mark = messages.sparkSession.range(1).select(
        F.lit(None).cast(pairs.schema["label"].dataType).alias("label"), F.lit("").alias("word"))
    listed = F.array_distinct("_words") if distinct else F.col("_words")
    every = keyed.select(*TEXT_KEY, F.explode(F.array_append(listed, F.lit(""))).alias("word"))
    hits = every.join(single.unionByName(mark), "word").select(
        *TEXT_KEY, "label", (F.col("word") == "").alias("_mark"), F.lit(1).cast("bigint").alias("n"))
    spaced = keyed.select(*TEXT_KEY, F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")).alias("_spaced"))
    phrases = several.withColumn("_phrase", F.concat(F.lit(" "), F.col("word"), F.lit(" ")))
    met = contains_join(spaced, "_spaced", phrases, "_phrase")
    met = met.withColumn("_words", F.array_remove(F.split("_spaced", " "), ""))
    uses = F.lit(1) if distinct else _uses(F.col("word"))
    hits = hits.unionByName(met.select(*TEXT_KEY, "label", F.lit(False).alias("_mark"), uses.cast("bigint").alias("n")))
    counted = hits.groupBy(*TEXT_KEY, "label", "_mark").agg(F.sum("n").alias("n"))
    gathered = counted.groupBy(*TEXT_KEY).agg(
        F.array_sort(F.collect_list(F.when(~F.col("_mark"), F.struct("label", "n")))).alias("_hits"),
        F.sum(F.when(F.col("_mark"), F.col("n"))).alias("_copies"),
    )
    own = F.transform("_hits", lambda h: F.struct(h["label"], F.call_function("div", h["n"], F.col("_copies")).alias("n")))
    votes = gathered.where(F.size("_hits") > 0).select(*TEXT_KEY, own.cast(VOTES).alias(column))
    joined = with_text_key(messages, text).join(votes, TEXT_KEY, "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.array().cast(VOTES))).drop(*TEXT_KEY)


def vote_terms(table: DataFrame, label: str) -> DataFrame:
    """``label, word``: terms in the form in which texts hold them, their words joined by one blank.

    A term may have several words or marks in it ("clean water", "it's"); one
    without any letter or digit is left out.
    """
    plain = F.array_join(words(F.col("word")), " ")
    return table.select(F.col(label).alias("label"), plain.alias("word")).where("word <> ''").distinct()


def _uses(phrase: Column) -> Column:
    """How often the words of a phrase stand in ``_words``, one after the other."""
    parts = F.split(phrase, " ")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_words") - F.size(parts) + 1))
    return F.size(F.filter(starts, lambda i: F.slice("_words", i, F.size(parts)) == parts))


def votes_for(votes: Column, label: str) -> Column:
    """The count of one label, 0 when it has none."""
    hit = F.get(F.filter(votes, lambda v: v["label"] == label), 0)
    return F.coalesce(hit["n"], F.lit(0).cast("bigint"))
