"""The bounded sample of labelled rows from which a classifier learns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import train_remainder


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return train_remainder(doc_id, modulus) == remainder


def known_labels(labels: DataFrame, label: str, modulus: int, remainder: int, id_column: str = "doc_id") -> DataFrame:
    """``sample_id, target`` of all labelled rows outside the held-out fold; an id counts once, with its larger label.

    Null ids and null labels are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.where(~held_out(F.col(id_column), modulus, remainder))
    return known.groupBy(F.col(id_column).alias("sample_id")).agg(F.max(label).cast("int").alias("target"))


def sample_ids(labels: DataFrame, label: str, modulus: int, remainder: int, per_class: int,
               id_column: str = "doc_id") -> DataFrame:
    """``sample_id, target`` (0 or 1) of at most ``per_class`` labelled rows of each class.

    Of ``known_labels``, those with the smallest hash of their id are taken, so a
    rerun takes the same. The bound is 16 bytes times two times
    ``per_class``: the table may be broadcast.
    """
    known = known_labels(labels, label, modulus, remainder, id_column)
    order = [F.xxhash64(F.lit(label), F.col("sample_id")), F.col("sample_id")]
    return (
        known.where("target = 1").orderBy(*order).limit(per_class)
        .unionByName(known.where("target = 0").orderBy(*order).limit(per_class))
    )


def sample_texts(docs: DataFrame, sample: DataFrame, text: str, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, text, target`` of the sampled ids, one row each; texts are filtered where they are read.

    Of several rows with one id the text with the smallest hash is taken, reduced
    in the tasks first: no more rows than ids come out, however often an id repeats.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    found = rows.join(F.broadcast(sample), rows["doc_id"] == F.col("sample_id"))
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "target")).alias("first")
    return found.groupBy("doc_id").agg(first).select("doc_id", "first.text", "first.target")
