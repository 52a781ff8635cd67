"""First or last row per key, and new-versus-stored comparison.

A third of all rows may carry one key. ``row_number() = 1`` is planned with a
per-task group limit, so a task hands on one row per key at most; counts are
partial aggregates. No key's rows ever meet in one task unreduced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.operators.sizing import rows_if_small
from feedlens.schema import id_number

STORED_KEY = ["country", "source", "id_", "datetime_", "text"]


def arrival_order() -> list[Column]:
    """Default order of messages: time, then numeric id, then id."""
    return [F.col("datetime_").asc(), id_number().asc(), F.col("id_").asc()]


def _one_per_key(df: DataFrame, key: list[str | Column], order: list[Column]) -> DataFrame:
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def first_per_key(
    messages: DataFrame, key: list[str] | None = None, order: list[Column] | None = None
) -> DataFrame:
    """Distinct by key (default the id), the first in ``order`` is kept."""
    return _one_per_key(messages, list(key or ["id_"]), order or arrival_order())


def first_per_text(messages: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Distinct by exact, case-sensitive text, per ``order``.

    The hash leads the key so that sorting compares eight bytes, not long texts.
    """
    key = [F.xxhash64("text"), F.col("text")]
    return _one_per_key(messages, key, order or arrival_order())


def last_version(stored: DataFrame, incoming: DataFrame, key: list[str], version: list[Column]) -> DataFrame:
    """Stored and incoming rows, one per key; incoming beats stored, then the latest ``version``."""
    both = stored.withColumn("_incoming", F.lit(0)).unionByName(
        incoming.withColumn("_incoming", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col("_incoming").desc(), *version]
    return _one_per_key(both, list(key), order).drop("_incoming")


_KEY_HASH = ["_key_1", "_key_2"]


def _with_key_hash(rows: DataFrame, key: list[str]) -> DataFrame:
    """Adds two 64-bit hashes of the key, in which a null has its place: what equality is tested by.

    Of stored rows nothing else is exchanged, of incoming ones the row itself once.
    """
    parts = [c for name in key for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return rows.withColumns(dict(zip(_KEY_HASH, (F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)))))


def _not_stored(rows: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    known = _with_key_hash(stored, key).select(*_KEY_HASH)
    return rows.join(known, _KEY_HASH, "left_anti").drop(*_KEY_HASH)


def new_rows(incoming: DataFrame, stored: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Incoming rows whose key is not stored; one row per key. Null keys match each other."""
    key = list(key or STORED_KEY)
    # which of several equal-keyed copies stays is fixed by their comparable columns
    order = [F.col(f"`{c}`") for c, kind in incoming.dtypes if "map<" not in kind]
    one = _one_per_key(_with_key_hash(incoming, key), _KEY_HASH, order)
    return _not_stored(one, stored, key).select(*[F.col(f"`{c}`") for c in incoming.columns])


def new_rows_strict(incoming: DataFrame, stored: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Incoming rows whose key occurs exactly once in incoming and stored together.

    A duplicate inside the batch drops both copies. As before, a batch is only
    compared where something is stored for its (country, source) within the
    batch's time bounds; elsewhere every row is new.
    """
    key = list(key or STORED_KEY)
    pair = ["country", "source"]
    bounds = batch_bounds(incoming)
    within = F.col("datetime_").between(F.col("min_datetime"), F.col("max_datetime"))
    window = stored.select(*pair, "datetime_").join(bounds, pair).where(within)
    active = window.select(*pair).distinct()
    rows = rows_if_small(active)
    if rows is not None:
        is_active = reduce(Column.__or__, [(F.col("country") == r[0]) & (F.col("source") == r[1]) for r in rows], F.lit(False))
        is_active = F.coalesce(is_active, F.lit(False))
        unchecked, checked = incoming.where(~is_active), incoming.where(is_active)
    else:
        unchecked = incoming.join(active, pair, "left_anti").select(*incoming.columns)
        checked = incoming.join(active, pair, "left_semi").select(*incoming.columns)

    # the key holds the time: stored rows outside the window meet nothing
    keyed = _with_key_hash(checked, key)
    alone = keyed.groupBy(*_KEY_HASH).agg(F.count("*").alias("_n")).where("_n = 1").select(*_KEY_HASH)
    single = _not_stored(keyed.join(alone, _KEY_HASH, "left_semi"), stored, key)
    return unchecked.unionByName(single.select(*[F.col(f"`{c}`") for c in incoming.columns]))


def batch_bounds(messages: DataFrame) -> DataFrame:
    """First and last datetime per (country, source)."""
    return messages.groupBy("country", "source").agg(
        F.min("datetime_").alias("min_datetime"), F.max("datetime_").alias("max_datetime")
    )


def insert_counts(incoming: DataFrame, inserted: DataFrame) -> DataFrame:
    """Per source: rows offered, inserted and found to be duplicates."""
    offered = incoming.groupBy("source").agg(F.count("*").alias("offered"))
    taken = inserted.groupBy("source").agg(F.count("*").alias("inserted"))
    both = offered.join(taken, "source", "left")
    return both.select(
        "source",
        "offered",
        F.coalesce("inserted", F.lit(0)).alias("inserted"),
        (F.col("offered") - F.coalesce("inserted", F.lit(0))).alias("duplicates"),
    )


def channel_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("source", "group").agg(F.count("*").alias("messages"))
