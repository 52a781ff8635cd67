"""Posts and their replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.joins import null_safe_left_join

SALTS = 16


def qualifies_for_replies() -> Column:
    """A post of a broadcast channel that has replies."""
    return F.col("broadcast") & F.col("post") & (F.coalesce(F.col("replies"), F.lit(0)) > 0)


def posts_with_replies(history: DataFrame, replies: DataFrame) -> DataFrame:
    """Channel history plus the landed replies to each qualifying post, in one join.

    ``history`` and ``replies`` are raw rows (see ``sources.raw``). The history is
    kept whole, answers within a group chat included; a landed reply is added if
    its parent id is that of a qualifying post of the same channel. One post may
    draw a third of all replies: its replies are spread over ``SALTS`` buckets, and
    the parent side, two narrow columns, is repeated for each bucket.
    """
    parents = (
        history.where(qualifies_for_replies())
        .select(F.col("channel").alias("_channel"), F.col("id").alias("_parent"))
        .distinct()
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = replies.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    same_thread = (
        F.col("channel").eqNullSafe(F.col("_channel"))
        & (F.col("reply_to.reply_to_msg_id") == F.col("_parent"))
        & (salted["_salt"] == parents["_salt"])
    )
    wanted = salted.join(parents, same_thread, "left_semi").drop("_salt")
    return history.unionByName(wanted)


def thread_reply_counts(messages: DataFrame) -> DataFrame:
    """Direct replies per message; replies are counted before they meet their parent."""
    counted = (
        messages.where(F.col("reply"))
        .groupBy("source", "group", F.col("reply_to").alias("id_"))
        .agg(F.count("*").alias("replies"), F.max("datetime_").alias("last_reply"))
    )
    plain = messages.select("source", "group", "id_", "datetime_")
    joined = null_safe_left_join(plain, counted, ["source", "group", "id_"])
    return joined.withColumn("replies", F.coalesce("replies", F.lit(0)))
