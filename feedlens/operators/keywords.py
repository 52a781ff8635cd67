"""Does a message mention one of the keywords?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import WHITESPACE, WORD, strip, whole_word_pattern
from feedlens.functions.wordlists import DEFAULT_KEYWORDS
from feedlens.operators.contains import contains_join
from feedlens.operators.joins import TEXT_KEY, with_text_key
from feedlens.operators.sizing import MAX_INLINE_ROWS, rows_if_small


def keyword_expression(text: Column, keywords: list[str]) -> Column:
    """True when the text has a keyword of several words as substring, or a single one as word."""
    lowered = F.lower(text)
    clean = [k.lower() for k in keywords if k and k.strip()]
    single = [k for k in clean if len(k.split()) == 1]
    multi = [k for k in clean if len(k.split()) > 1]
    tests = [F.contains(lowered, F.lit(k)) for k in multi]
    if single:
        tests.append(lowered.rlike(whole_word_pattern(single)))
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def keyword_flag(
    messages: DataFrame,
    keywords: DataFrame | list[str] | None = None,
    column: str = "keyword_flag",
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """Add a boolean column. A short keyword table becomes one pattern; a long one is joined.

    Without keywords those of ``wordlists.DEFAULT_KEYWORDS`` are looked for.
    """
    if keywords is None:
        keywords = DEFAULT_KEYWORDS
    if isinstance(keywords, list):
        return messages.withColumn(column, keyword_expression(F.col("text"), keywords))
    rows = rows_if_small(keywords.select("keyword"), max_inline)
    if rows is not None:
        listed = [row["keyword"] for row in rows]
        return messages.withColumn(column, keyword_expression(F.col("text"), listed))

    lowered = with_text_key(messages, F.col("text")).withColumn("_lower", F.lower("text"))
    table = keywords.select(F.lower("keyword").alias("_keyword")).where(strip(F.col("_keyword")) != "").distinct()
    quoted = F.regexp_replace(F.col("_keyword"), r"([\\.\[\]{}()*+\-?^$|&~#])", r"\\$1")
    as_word = F.concat(F.lit(rf"(^|[^{WORD}])("), quoted, F.lit(rf")($|[^{WORD}])"))
    several = F.size(F.split(strip(F.col("_keyword")), rf"[{WHITESPACE}]+")) > 1
    hits = contains_join(lowered.select(*TEXT_KEY, "_lower"), "_lower", table, "_keyword").where(
        several | F.regexp_like(F.col("_lower"), as_word)
    )
    flagged = hits.select(*TEXT_KEY).distinct().withColumn("_hit", F.lit(True))
    joined = lowered.drop("_lower").join(flagged, TEXT_KEY, "left")
    return joined.withColumn(column, F.coalesce("_hit", F.lit(False))).drop("_hit", *TEXT_KEY)
