"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")  # the default of a parameter
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = r"[^\x20\x09-\x0D]+"

#: rows and bytes of one Arrow batch: a Python worker holds a few batches at a time
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; also bounds the Arrow batches of the session."""
    batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches(spark: SparkSession) -> SparkSession:
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if value is None else value for value in column.cast(kind).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """The maximal runs of bytes other than space and 0x09-0x0D."""
    return text.split()


def send(spark: SparkSession, value: object) -> Broadcast:
    """Broadcasts a value; classes of this package go along, so that it need not be installed on the executors."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> object:
    """The value of ``send``, unpacked: once per task, not per batch."""
    return pickle.loads(sent.value)


def map_batches(df: DataFrame, function: Callable[..., pa.RecordBatch], schema: str | T.StructType,
                sent: Broadcast | None = None) -> DataFrame:
    """``mapInArrow`` for a function of one batch, and of the value of ``send`` if there is one."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = () if sent is None else (received(sent),)
        for batch in stream:
            if batch.num_rows:
                yield function(batch, *more)

    return df.mapInArrow(run, schema)


def merged(df: DataFrame) -> DataFrame:
    """A side of a join of two tables that grow with the input: both are sorted and merged, none goes through the driver.

    Spark takes a written table for as large as its files, and what Python makes of a
    table for no larger than that table, however many rows come of one. Either may be
    under its limit for a broadcast and be many times as large in the driver's memory.
    """
    return df.hint("merge")


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def train_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def with_fields(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    out = T.StructType(list(schema.fields))
    for name, kind in fields:
        out = out.add(T.StructField(name, T._parse_datatype_string(kind)))
    return out
