"""Row filters and guards."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import has_text, long_enough

GUARDED_COLUMNS = ["datetime_", "country", "source"]


def min_length(messages: DataFrame, minimum: int = 20) -> DataFrame:
    return messages.where(long_enough(F.col("text"), minimum))


def non_empty(messages: DataFrame) -> DataFrame:
    return messages.where(has_text(F.col("text")))


def since(messages: DataFrame, as_of: datetime | date | str, days: int = 14) -> DataFrame:
    """Messages from the start of the day ``days`` before ``as_of``; no upper bound."""
    first_day = F.date_sub(F.to_date(F.lit(str(as_of)).cast("timestamp_ntz")), days)
    return messages.where(F.col("datetime_") >= first_day.cast("timestamp_ntz"))


def _timestamp(value: datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def required_range(
    messages: DataFrame,
    start: datetime | str,
    end: datetime | str,
    country: str,
    source: str,
) -> DataFrame:
    """Equality on country and source, time range inclusive at both ends."""
    for name, value in {"start": start, "end": end, "country": country, "source": source}.items():
        if value is None:
            raise ValueError(f"please specify {name} to query the message table")
    return optional_range(messages, start, end, country, source)


def optional_range(
    messages: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    country: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """The conjunction of whichever predicates are given."""
    wanted: list[Column] = []
    if country is not None:
        wanted.append(F.col("country") == country)
    if source is not None:
        wanted.append(F.col("source") == source)
    if start is not None:
        wanted.append(F.col("datetime_") >= _timestamp(start))
    if end is not None:
        wanted.append(F.col("datetime_") <= _timestamp(end))
    return messages.where(reduce(Column.__and__, wanted)) if wanted else messages


def null_counts(messages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: how many nulls each guarded column holds."""
    return messages.agg(
        *[
            F.count_if(F.col(c).isNull()).alias(f"null_{c.rstrip('_')}")
            for c in columns or GUARDED_COLUMNS
        ]
    )


def require_not_null(messages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fail the job at the first row that lacks a guarded column; costs no extra pass."""
    for name in columns or GUARDED_COLUMNS:
        message = F.lit(f"please specify {name} before saving messages")
        value = F.col(name)
        messages = messages.withColumn(
            name,
            F.when(value.isNull(), F.raise_error(message).cast(messages.schema[name].dataType)).otherwise(value),
        )
    return messages


def originals_only(posts: DataFrame) -> DataFrame:
    """Posts that are not re-shares; an unknown flag counts as original."""
    return posts.where(~F.coalesce(F.col("is_reshare"), F.lit(False)))
