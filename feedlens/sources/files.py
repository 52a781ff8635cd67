"""CSV files of messages, local or on any storage Spark has a URI for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.codec import decode_legacy_nested, decode_nested, encode_rows
from feedlens.schema import MESSAGE_COLUMNS, to_messages
from feedlens.session import spread

CSV_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in MESSAGE_COLUMNS])
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
# An unquoted empty cell is null, a quoted one an empty text: they only stay
# apart when the mark for null is not itself the empty string.
READ_OPTIONS = {**CSV_OPTIONS, "multiLine": True, "nullValue": "\0", "emptyValue": ""}
# from_csv takes texts, and line breaks within them as they are
_PARSE_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\0", "emptyValue": ""}
#: size of a file that is worth two exchanges of its lines to be read by more than one task
RANGES_FROM = 256 << 20


def messages_path(path: str) -> str:
    """A path that names no CSV gets ``messages.csv`` appended."""
    return path if path.endswith(".csv") else f"{path.rstrip('/')}/messages.csv"


def write_csv(messages: DataFrame, path: str) -> str:
    """Overwrite; nested parts become JSON text. Returns the path written."""
    target = messages_path(path)
    (
        encode_rows(messages)
        .write.mode("overwrite")
        .options(**CSV_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(target)
    )
    return target


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, text``: the records of CSV files, numbered from 1 in each file, by all tasks.

    Files are read by line in byte ranges. A line begins a record if the number of
    quotes before it in its file is even: quotes are summed up per range, the sums
    over the ranges of a file, and the records likewise, so no task sees more than
    a range, or the sums of the ranges of one file. The lines of a record then
    meet, a record's size being the only group that is gathered.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        F.length(F.regexp_replace("value", '[^"]+', "")).alias("quotes"),
    )
    in_range = Window.partitionBy("file", "range").orderBy("at")
    earlier = in_range.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.pmod(F.coalesce(F.sum("quotes").over(earlier), F.lit(0)), F.lit(2))
    # whether the quotes of the range before the line are odd, not counting those before the range
    lines = lines.withColumn("odd", odd.cast("int"))
    sums = lines.groupBy("file", "range").agg(
        F.sum("quotes").alias("quotes"), F.count_if(F.col("odd") == 0).alias("evens"), F.count_if(F.col("odd") == 1).alias("odds")
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    turned = sums.withColumn("turn", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).cast("int"))
    begun = turned.withColumn("begun", F.when(F.col("turn") == 0, F.col("evens")).otherwise(F.col("odds")))
    offsets = begun.select("file", "range", "turn", F.coalesce(F.sum("begun").over(before), F.lit(0)).alias("skip"))
    placed = lines.join(offsets, ["file", "range"])
    begins = (F.col("odd") == F.col("turn")).cast("int")
    numbered = placed.withColumn("record", F.col("skip") + F.sum(begins).over(in_range))
    parts = F.array_sort(F.collect_list(F.struct("range", "at", "line")))
    whole = F.array_join(F.transform(parts, lambda p: p["line"]), "\n")
    return numbered.groupBy("file", "record").agg(F.regexp_replace(whole, "\r$", "").alias("text"))


def _read_in_ranges(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of CSV files with a header each, parsed record by record."""
    parsed = F.from_csv("text", ", ".join(f"`{f.name}` string" for f in schema), _PARSE_OPTIONS)
    return _records(spark, path).where((F.col("record") > 1) & (F.trim("text") != "")).select(parsed.alias("r")).select("r.*")


def _largest_file(spark: SparkSession, path: str) -> int:
    listed = spark.read.format("binaryFile").load(path)
    return listed.agg(F.max("length")).first()[0] or 0


def read_csv(spark: SparkSession, path: str, legacy: bool = False, in_ranges: bool | None = None) -> DataFrame:
    """Messages from a CSV file or folder.

    Texts hold line breaks, so a file is read as a whole by one task, and the rows
    of a few files are dealt out afterwards. Files of ``RANGES_FROM`` bytes and more
    are read in byte ranges by all tasks (``in_ranges`` decides it otherwise); there
    a quote must be quoted and doubled, as every common writer does, and a file
    ends its records with line feeds, with or without carriage returns, and texts
    keep their own line breaks, where the reader of whole files makes line feeds of
    those that the file ends its records with. ``legacy`` files have their own
    column order and hold nested parts as Python literals.
    """
    target = messages_path(path)
    reader = spark.read.options(**READ_OPTIONS)
    if in_ranges is None:
        in_ranges = _largest_file(spark, target) >= RANGES_FROM
    if legacy:
        flat = reader.option("inferSchema", False).csv(target)
        if in_ranges:
            flat = _read_in_ranges(spark, target, flat.schema)
        return to_messages(decode_legacy_nested(flat if in_ranges else spread(flat)))
    if in_ranges:
        return to_messages(decode_nested(_read_in_ranges(spark, target, CSV_SCHEMA)))
    return to_messages(decode_nested(spread(reader.schema(CSV_SCHEMA).csv(target))))


def save_snapshot(messages: DataFrame, folder: str, source: str, start: str, end: str) -> str:
    """Intermediate result of an extraction, named by source and dates."""
    return write_csv(messages, f"{folder}/{source}_messages_{start}_{end}.csv")
