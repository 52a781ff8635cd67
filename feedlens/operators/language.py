"""Language detection by stop-word vote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.wordlists import STOPWORD_LANGUAGES, stopword_table
from feedlens.operators.sizing import MAX_INLINE_ROWS
from feedlens.operators.tokens import class_votes


def detect_language(
    messages: DataFrame,
    stopwords: DataFrame | None = None,
    column: str = "detected_lang",
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """Add the language with most stop-word occurrences; the lower code wins a tie, null without any.

    Without a table, the stop words that Spark ships are taken, of all languages it has them for.
    """
    if stopwords is None:
        stopwords = stopword_table(messages.sparkSession, sorted(STOPWORD_LANGUAGES))
    voted = class_votes(
        messages, stopwords, "lang", F.col("text"), max_inline=max_inline
    )
    ballots = F.transform(
        "_votes", lambda v: F.struct((-v["n"]).alias("n"), v["label"].alias("lang"))
    )
    return voted.withColumn(column, F.array_min(ballots)["lang"]).drop("_votes")


def language_confusion(
    messages: DataFrame, actual: str = "lang", detected: str = "detected_lang"
) -> DataFrame:
    return messages.groupBy(actual, detected).agg(F.count("*").alias("messages"))
