"""Joins on keys that may hold nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys meet; the key columns of the left side are kept."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in key})
    on = reduce(
        Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_r_{c}`")) for c in key]
    )
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in key])


def null_safe_left_join(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    return null_safe_join(left, right, key, "left")


TEXT_KEY = ["_text_1", "_text_2"]


def with_text_key(messages: DataFrame, *columns: Column, names: list[str] | None = None) -> DataFrame:
    """Adds ``TEXT_KEY`` (or ``names``): two 64-bit hashes of ``columns``.

    What depends on these columns alone can be computed under it and joined back,
    whatever identifies a message: equal and null message keys do no harm, and
    copies of a text are worked on once.
    """
    first, second = names or TEXT_KEY
    return messages.withColumns({first: F.xxhash64(*columns), second: F.xxhash64(F.lit("second"), *columns)})
