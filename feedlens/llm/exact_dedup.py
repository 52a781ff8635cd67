"""Exact de-duplication by two-pass Bloom filtering.

The first pass over the digests fills a two-plane Bloom filter (``bloom``), the
second reads it: a row whose digest cannot be repeated passes straight through,
the others meet in an exchange on the digest and are grouped exactly.

Rows, one by one:
- a null text counts as empty, and empty texts equal each other;
- of equal texts the row with the largest id stays, a null id is smaller than any
  other; of rows that also share the id, exactly one stays;
- texts of any length are hashed whole; an empty table gives an empty result;
- other columns are never read and are kept by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm import bloom
from feedlens.llm.common import batches, map_batches, unused, utf8, with_fields
from feedlens.session import cut_lineage


def _digest(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()  # bytes.lower() changes A-Z only


def _hashes(digests: pa.Array) -> np.ndarray:
    """The first 64 bits of each digest, which the filter goes by."""
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)[:, 0]


def text_digests(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, row_no, digest`` of every row, written once to the shared folder."""
    batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = pa.array(map(_digest, utf8(batch, "text")), pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), made], names=["doc_id", "digest"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = map_batches(rows, digest, f"doc_id {kind}, digest binary")
    return cut_lineage(made.withColumn("row_no", F.monotonically_increasing_id()))


def _repeat_filter(digests: DataFrame, max_bytes: int):
    bits = bloom.plane_bits(digests.count(), max_bytes)
    plane = bloom.repeated_plane(digests.select("digest"), lambda batch: _hashes(batch.column(0)), bits)
    return digests.sparkSession.sparkContext.broadcast(plane)


def duplicate_groups(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                     max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = text_digests(docs, text, id_column)
    plane = _repeat_filter(digests, max_bytes)

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = bloom.contains(plane.value, _hashes(batch.column("digest")))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], names=[*batch.schema.names, "maybe"])

    probed = map_batches(digests, probe, with_fields(digests.schema, ("maybe", "boolean")))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    single = probed.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    )
    repeats = cut_lineage(probed.where("maybe").drop("maybe"))
    groups = cut_lineage(
        repeats.groupBy("digest").agg(F.max(F.struct("doc_id", "row_no")).alias("keep"), F.count("*").alias("group_size"))
        .select("digest", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row_no").alias("keep_row"), "group_size")
    )
    several = repeats.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), sha
    )
    return single.unionByName(several)


def drop_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id",
                max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """``docs`` without the copies: one whole row of each group of equal texts.

    Rows that cannot be repeated never enter an exchange. Of the others each task
    keeps its best row per digest before the exchange (a window group limit), so a
    text that fills a third of the table sends one row per task.
    """
    digests = text_digests(docs, text, id_column)
    plane = _repeat_filter(digests.select("digest"), max_bytes)
    at, maybe, place = unused(docs, "digest"), unused(docs, "maybe"), unused(docs, "place")

    def tag(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = pa.array(map(_digest, utf8(batch, text)), pa.binary())
        hit = bloom.contains(plane.value, _hashes(made))
        return pa.RecordBatch.from_arrays([*batch.columns, made, pa.array(hit)], names=[*batch.schema.names, at, maybe])

    tagged = map_batches(docs, tag, with_fields(docs.schema, (at, "binary"), (maybe, "boolean")))
    single = tagged.where(~F.col(maybe)).select(docs.columns)
    best = Window.partitionBy(at).orderBy(F.col(id_column).desc(), F.col(text))
    several = tagged.where(maybe).withColumn(place, F.row_number().over(best)).where(F.col(place) == 1)
    return single.unionByName(several.select(docs.columns))
