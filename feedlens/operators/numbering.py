"""Consecutive numbers within a group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.session import cut_lineage

MAX_BROADCAST_ROWS = 200_000


def number_rows(
    df: DataFrame, group: list[str], order: list[Column], column: str = "number", row_key: list[str] | None = None
) -> DataFrame:
    """Add 1, 2, 3… within ``group`` by ``order``, which must break every tie.

    A window would sort a whole group in one task. Here the rows are
    range-partitioned, so a large group spans many tasks; each task numbers its
    stretch, and the stretches are offset by a prefix sum over their counts.
    Range bounds are sampled and may differ between two evaluations, so the
    partitioned rows are written to the shared folder before they are counted.

    With a ``row_key``, columns without nulls that are unique over all rows, only
    the key and the group are partitioned and written, and the number is joined to
    the rows by the key. ``df`` is then read twice, once for the columns of
    ``group``, ``order`` and ``row_key`` alone.
    """
    if row_key is not None:
        narrow = _numbered(df, group, order, column, [*row_key, *[c for c in group if c not in row_key]])
        return df.join(narrow.select(*row_key, column), row_key).select(*[F.col(f"`{c}`") for c in df.columns], column)
    return _numbered(df, group, order, column, df.columns)


def _numbered(df: DataFrame, group: list[str], order: list[Column], column: str, kept: list[str]) -> DataFrame:
    keys = [F.col(f"`{c}`").asc() for c in group]
    spread = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias("_at"))
    )
    # the upper bits of the id are the partition, the lower 33 the row in it
    fixed = cut_lineage(spread).withColumn("_part", F.shiftright("_at", 33))
    stretches = fixed.groupBy(*group, "_part").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_from")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    renamed = cut_lineage(offsets).select(
        *[F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_part").alias("_p"),
        "_from",
        "_skip",
    )
    on = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(f"_g{i}"))
    # one row per partition and one per group border: counted, then sent to the rows
    small = renamed.count() <= MAX_BROADCAST_ROWS
    numbered = fixed.join(F.broadcast(renamed) if small else renamed, on)
    number = F.col("_at") - F.col("_from") + F.col("_skip") + 1
    return numbered.select(*[F.col(f"`{c}`") for c in kept], number.alias(column))
