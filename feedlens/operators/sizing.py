"""Checks of a lookup table's size before it is folded into an expression."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MAX_INLINE_ROWS = 500


def constant(value: list | dict, kind: str) -> Column:
    """A constant of a nested type, sent as one string and folded at planning time."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def rows_if_small(df: DataFrame, limit: int = MAX_INLINE_ROWS) -> list[Row] | None:
    """All rows of a table of at most ``limit`` rows, else ``None``.

    At most ``limit + 1`` rows ever reach the driver.
    """
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None
