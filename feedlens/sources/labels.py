"""The label dictionary of a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def label_table(spark: SparkSession, path: str) -> DataFrame:
    """``ix, label`` from a JSON object ``{"0": label, "1": label, ...}``, to be joined on the index."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("ix", "label"))
    return pairs.select(F.col("ix").cast("int").alias("ix"), "label")


def read_labels(spark: SparkSession, path: str) -> list[str]:
    """The labels of one classifier in index order: as many as its model has outputs."""
    ordered = sorted(label_table(spark, path).collect(), key=lambda row: row["ix"])
    if [row["ix"] for row in ordered] != list(range(len(ordered))):
        raise ValueError(f"label indexes of {path} are not 0, 1, 2...")
    return [row["label"] for row in ordered]
