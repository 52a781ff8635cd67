"""Review sets as Parquet, one partition per workspace and data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_review_set(records: DataFrame, path: str, replace: bool = True) -> None:
    """Store records per (workspace, dataset); an old set of that name is replaced or is an error."""
    # adaptive execution splits a large set over several files and merges small ones
    gathered = records.hint("rebalance", F.col("workspace"), F.col("dataset"))
    writer = gathered.write.partitionBy("workspace", "dataset")
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        return
    spark = records.sparkSession
    names = records.select("workspace", "dataset").distinct()
    try:
        old = spark.read.parquet(path).select("workspace", "dataset").distinct()
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
    else:
        clash = names.join(old, ["workspace", "dataset"], "left_semi").limit(1).collect()
        if clash:
            raise ValueError(f"review set {clash[0]['dataset']} exists in workspace {clash[0]['workspace']}")
    writer.mode("append").parquet(path)


def read_review_set(spark: SparkSession, path: str, dataset: str, workspace: str) -> DataFrame:
    stored = spark.read.parquet(path)
    return stored.where((F.col("workspace") == workspace.lower()) & (F.col("dataset") == dataset))


def decode_metadata(records: DataFrame, schema: str | StructType) -> DataFrame:
    """Metadata that arrives as JSON text becomes a struct."""
    return records.withColumn("metadata", F.from_json("metadata", schema))
