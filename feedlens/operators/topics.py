"""The set of topics in use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import cut_lineage, lookup_table


def topic_vocabulary(messages: DataFrame, fallback: list[str] | None = None) -> DataFrame:
    """``(topic, messages)`` over all classifications.

    Where no message has any, the ``fallback`` labels; without those the job fails.
    """
    used = (
        messages.select(F.explode(F.array_distinct("classifications.topic")).alias("topic"))
        .groupBy("topic")
        .agg(F.count("*").alias("messages"))
    )
    used = cut_lineage(used)  # few rows; the classification behind them is not evaluated again
    spark = messages.sparkSession
    if fallback:
        spare = lookup_table(spark, [(label,) for label in fallback], "topic string")
        spare = spare.select("topic", F.lit(0).cast("bigint").alias("messages"))
        return used.unionByName(spare.where(~used.exists()))
    reason = "the messages have no topics: give fallback labels"
    alarm = spark.range(1).where(~used.exists()).select(
        F.raise_error(F.lit(reason)).cast("string").alias("topic"), F.lit(0).cast("bigint").alias("messages")
    )
    return used.unionByName(alarm)
