"""Nested parts to and from text, and whole messages to JSON."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.schema import (
    CLASSIFICATION,
    INFO,
    ISO_FORMAT,
    MESSAGE_COLUMNS,
    SQL_FORMAT,
    TRANSLATION,
)

NESTED = {
    "translations": T.ArrayType(TRANSLATION),
    "info": INFO,
    "classifications": T.ArrayType(CLASSIFICATION),
}


def encode_rows(df: DataFrame) -> DataFrame:
    """Messages as flat text columns, for CSV files and SQL tables."""
    out = []
    for name in MESSAGE_COLUMNS:
        value = F.col(f"`{name}`")
        if name in NESTED:
            value = F.to_json(value)
        elif name in ("datetime_", "datetime_scraped_"):
            value = F.date_format(value, SQL_FORMAT)
        out.append(value.alias(name))
    return df.select(*out)


def decode_nested(df: DataFrame) -> DataFrame:
    """Turn the JSON text of the nested columns back into typed values."""
    for name, kind in NESTED.items():
        if name in df.columns:
            df = df.withColumn(name, F.from_json(F.col(name), kind))
    return df


def message_json(id_name: str = "id") -> Column:
    """The document-store form of a message: string id, ISO datetimes, nulls kept."""
    parts = []
    for name in MESSAGE_COLUMNS:
        value = F.col(f"`{name}`")
        if name == "id_":
            parts.append(value.cast("string").alias(id_name))
        elif name in ("datetime_", "datetime_scraped_"):
            parts.append(F.date_format(value, ISO_FORMAT).alias(name))
        else:
            parts.append(value.alias(name))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def _literal_to_json(cell: str | None) -> str | None:
    if cell is None or cell == "":
        return None
    try:
        return json.dumps(ast.literal_eval(cell), default=str)
    except (ValueError, SyntaxError):
        return None


@F.pandas_udf(T.StringType())
def python_literal_to_json(cells: pd.Series) -> pd.Series:
    """Old exports hold ``str(dict)`` cells, which are Python, not JSON."""
    return cells.map(_literal_to_json)


def decode_legacy_nested(df: DataFrame) -> DataFrame:
    """Nested columns of old exports: known keys become fields, others ``info.extra``."""
    known = [f.name for f in INFO if f.name != "extra"]
    for name in NESTED:
        df = df.withColumn(name, python_literal_to_json(F.col(name)))
    every = F.from_json(F.col("info"), "map<string,string>")
    rest = F.map_filter(every, lambda k, _: ~k.isin(known))
    parsed = F.from_json(F.col("info"), INFO)
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in NESTED],
        F.from_json("translations", NESTED["translations"]).alias("translations"),
        parsed.withField("extra", F.when(F.size(rest) > 0, rest)).alias("info"),
        F.from_json("classifications", NESTED["classifications"]).alias("classifications"),
    )
