"""Incremental ingest, dedupe within the trailing window, and upsert."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedlens.schema import MESSAGE_COLUMNS
from feedlens.sources.store import MessageStore

HELD_KEYS = 200_000


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New files of a landing folder; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def first_of_task(messages: DataFrame, key: list[str]) -> DataFrame:
    """One row per key of each task's share of a micro-batch, without state.

    A stream has no partial aggregation; this takes its place, so that of a hot id
    each task hands on one row. A task remembers ``HELD_KEYS`` hashes and starts
    anew beyond them, which lets a copy pass and nothing else.
    """

    @F.arrow_udf("boolean")
    def is_first(keys: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: set = set()
        for batch in keys:
            out = []
            for value in batch.to_pylist():
                value = tuple(value.values()) if isinstance(value, dict) else value
                out.append(value not in seen)
                seen.add(value)
            if len(seen) > HELD_KEYS:
                seen.clear()
            yield pa.array(out, pa.bool_())

    columns = [F.col(f"`{c}`") for c in key]
    return messages.where(is_first.asNondeterministic()(columns[0] if len(columns) == 1 else F.struct(*columns)))


def dedupe_stream(messages: DataFrame, window: str = "14 days", key: list[str] | None = None) -> DataFrame:
    """One row per id within the window, the first one seen.

    State holds each id of the window once; with ``session.SESSION_CONF`` it lies in
    RocksDB on the executors' disks, not in their heap. A watermark needs an
    instant, so the zone-free time is read as UTC (the session's zone). Copies of a
    hot id are dropped where they are read first. Of rows with equal keys the first
    stays; null keys are equal.
    """
    key = list(key or ["id_"])
    timed = first_of_task(messages, key).withColumn("_event_time", F.col("datetime_").cast("timestamp"))
    return timed.withWatermark("_event_time", window).dropDuplicatesWithinWatermark(key).drop("_event_time")


def write_stream(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet files, exactly once, until what has landed is processed."""
    return (
        messages.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(messages: DataFrame, store: MessageStore, checkpoint: str) -> StreamingQuery:
    """Upsert each micro-batch. One that is replayed is known by its number and passed over."""

    def merge(batch: DataFrame, number: int) -> None:
        store.upsert(batch.select(*[F.col(f"`{c}`") for c in MESSAGE_COLUMNS]), batch=(checkpoint, number))

    return (
        messages.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
