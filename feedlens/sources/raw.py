"""Landed raw exports: channel history, public posts, survey forms."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.text import fold
from feedlens.operators.contains import contains_join
from feedlens.operators.dedupe import first_per_key
from feedlens.operators.filters import non_empty, originals_only
from feedlens.operators.threads import posts_with_replies
from feedlens.operators.totals import observed
from feedlens.schema import info_struct, parse_datetime, to_messages

CHANNEL_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("message", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("reply_to", T.StructType([T.StructField("reply_to_msg_id", T.LongType())])),
        T.StructField("post", T.BooleanType()),
        T.StructField("replies", T.LongType()),
        T.StructField("broadcast", T.BooleanType()),
    ]
)
POST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("user", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("is_reshare", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
FORM_SCHEMA = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("_id", T.LongType()),
                        T.StructField("_submission_time", T.StringType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("group", T.StringType()),
                    ]
                )
            ),
        )
    ]
)


def read_json(spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Landed JSON with a declared schema. A file lost between listing and reading is skipped."""
    reader = spark.read.schema(schema).option("ignoreMissingFiles", True)
    return reader.option("multiLine", multi_line).json(paths)


def read_records(spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Every landed record with its file: ``file, malformed, record``.

    A record is a line that is not blank, or with ``multi_line`` a file. It is
    malformed if it is no JSON or if any field, read later or not, does not have
    its declared type; the fields that could be read are in ``record``.
    """
    marked = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    lines = spark.read.option("ignoreMissingFiles", True).text(paths, wholetext=multi_line)
    # an explicit option keeps Spark from parsing only the fields that are used
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    parsed = lines.where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.from_json("value", marked, options).alias("record")
    )
    malformed = F.col("record").isNull() | F.col("record._malformed").isNotNull()
    return parsed.select("file", malformed.alias("malformed"), F.col("record").dropFields("_malformed").alias("record"))


def input_account(records: DataFrame, empty: Column) -> DataFrame:
    """Per file: ``records, good, malformed, empty``; ``empty`` tells of a whole record that it holds nothing to read.

    Files without any record have no row.
    """
    bad = F.col("malformed")
    hollow = ~bad & F.coalesce(empty, F.lit(True))
    return records.groupBy("file").agg(
        F.count("*").alias("records"), F.count_if(~bad & ~hollow).alias("good"),
        F.count_if(bad).alias("malformed"), F.count_if(hollow).alias("empty"),
    )


class InputCheck:
    """Counts records and malformed ones while a job reads them, and refuses too large a share."""

    def __init__(self, max_malformed: float):
        self.max_malformed = max_malformed
        self.seen = Observation(f"input-{uuid.uuid4().hex}")

    def watch(self, records: DataFrame) -> DataFrame:
        """The fields of the records, counted when an action reads them."""
        counted = records.observe(
            self.seen, F.count(F.lit(1)).alias("records"), F.count_if(F.col("malformed")).alias("malformed")
        )
        return counted.select("record.*")

    def refuse(self) -> dict[str, int]:
        """After the action: the two counts, or an error if too many records were malformed."""
        counts = observed(self.seen, ["records", "malformed"])
        if counts["malformed"] > self.max_malformed * counts["records"]:
            raise RuntimeError(
                f"{counts['malformed']} of {counts['records']} landed records are malformed, "
                f"more than the stated share of {self.max_malformed}"
            )
        return counts


def _landed(spark: SparkSession, path, schema: T.StructType, check: InputCheck | None, multi_line: bool = False) -> DataFrame:
    if check is None:
        return read_json(spark, path, schema, multi_line)
    return check.watch(read_records(spark, path, schema, multi_line))


def _from_day(column: Column, since: datetime | date | str) -> Column:
    return column >= F.to_date(F.lit(str(since)).cast("timestamp_ntz")).cast("timestamp_ntz")


def normalize_channel_rows(
    raw: DataFrame, country: str, scraped_at: datetime | str, members: DataFrame | None = None, source: str = "Telegram"
) -> DataFrame:
    """Raw channel rows as messages; the reply header gives flag and parent.

    ``members(channel, members)`` adds the member count; Spark broadcasts it
    while its statistics say it is small.
    """
    parent = F.col("reply_to.reply_to_msg_id")
    count = F.lit(0)
    if members is not None:
        raw = raw.join(members.select("channel", "members"), "channel", "left")
        count = F.coalesce("members", F.lit(0))
    return to_messages(
        raw.select(
            F.col("id").cast("string").alias("id_"),
            F.col("date").alias("datetime_"),
            F.lit(str(scraped_at)).cast("timestamp_ntz").alias("datetime_scraped_"),
            F.lit(country).alias("country"),
            F.lit(source).alias("source"),
            F.col("channel").alias("group"),
            F.col("message").alias("text"),
            F.col("reply_to").isNotNull().alias("reply"),
            parent.cast("string").alias("reply_to"),
            info_struct(count).alias("info"),
        )
    )


def scan_channels(
    raw: DataFrame,
    channels: list[str] | DataFrame,
    since: datetime | date | str,
    country: str,
    scraped_at: datetime | str,
    members: DataFrame | None = None,
    with_replies: bool = False,
    key: list[str] | None = None,
) -> DataFrame:
    """Messages of the channels from the start of the day ``since``, no upper bound.

    A channel without data contributes nothing. Replies to the posts of a
    broadcast channel come from outside its history: such landed rows (a reply
    header, no post) are kept if their parent is a broadcast post with replies;
    without ``with_replies`` they are taken unchecked. Everything else is history and stays, answers
    within a group chat included. Ids are made unique (default key: the id alone;
    ``["source", "group", "id_"]`` where ids of channels can collide), empty
    texts dropped.
    """
    recent = raw.where(_from_day(F.col("date"), since))
    if isinstance(channels, DataFrame):
        recent = recent.join(channels.select("channel").distinct(), "channel", "left_semi")
    else:
        recent = recent.where(F.col("channel").isin(channels))
    landed = F.col("reply_to").isNotNull() & F.col("broadcast") & ~F.coalesce("post", F.lit(False))
    is_reply = F.coalesce(landed, F.lit(False))
    if with_replies:
        recent = posts_with_replies(recent.where(~is_reply), recent.where(is_reply))
    messages = normalize_channel_rows(recent, country, scraped_at, members)
    return first_per_key(non_empty(messages), key)


def normalize_posts(posts: DataFrame, country: str, scraped_at: datetime | str, source: str = "Twitter") -> DataFrame:
    return to_messages(
        posts.select(
            F.col("id").cast("string").alias("id_"),
            F.col("created_at").alias("datetime_"),
            F.lit(str(scraped_at)).cast("timestamp_ntz").alias("datetime_scraped_"),
            F.lit(country).alias("country"),
            F.lit(source).alias("source"),
            F.col("user").alias("group"),
            F.col("text"),
        )
    )


def user_timeline(posts: DataFrame, users: list[str] | DataFrame) -> DataFrame:
    """All posts of the users that are not re-shares."""
    if isinstance(users, DataFrame):
        mine = posts.join(users.select("user").distinct(), "user", "left_semi")
    else:
        mine = posts.where(F.col("user").isin(users))
    return originals_only(mine)


def search_posts(posts: DataFrame, queries: DataFrame, force_shuffle: bool = False) -> DataFrame:
    """Posts whose text contains one of the query strings, case-insensitively, once per row.

    Copies of a post are left to the caller, who knows which is first.
    """
    # posts with a hit carry their columns along, so no other post is shuffled
    texts = posts.withColumn("_text", F.lower("text"))
    phrases = queries.select(fold(F.col("query")).alias("_query")).distinct()
    found = contains_join(texts, "_text", phrases, "_query", force_shuffle)
    return found.select(*[F.col(f"`{c}`") for c in posts.columns])


def scan_posts(
    posts: DataFrame,
    country: str,
    scraped_at: datetime | str,
    users: list[str] | DataFrame | None = None,
    queries: DataFrame | None = None,
) -> DataFrame:
    """Timelines and search results together, distinct by id."""
    parts = []
    if users is not None:
        parts.append(user_timeline(posts, users))
    if queries is not None:
        parts.append(search_posts(posts, queries))
    if not parts:
        raise ValueError("give users, queries or both")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return first_per_key(normalize_posts(both, country, scraped_at))


def scan_forms(exports: DataFrame, country: str, asset: str, scraped_at: datetime | str) -> DataFrame:
    """One message per record of each form export's ``results``."""
    records = exports.select(F.explode("results").alias("r")).select("r.*")
    return to_messages(
        records.select(
            F.col("_id").cast("string").alias("id_"),
            parse_datetime(F.col("_submission_time")).alias("datetime_"),
            F.lit(str(scraped_at)).cast("timestamp_ntz").alias("datetime_scraped_"),
            F.lit(country).alias("country"),
            F.lit("Kobo").alias("source"),
            F.col("group"),
            F.col("text"),
            info_struct(extra=F.create_map(F.lit("kobo_asset"), F.lit(asset))).alias("info"),
        )
    )


def _read_channels(
    spark: SparkSession, path, since, country, scraped_at, channels=None, members=None, check=None, **options
):
    raw = _landed(spark, path, CHANNEL_SCHEMA, check)
    return scan_channels(raw, channels or [], since, country, scraped_at, members, **options)


def _read_posts(spark: SparkSession, path, since, country, scraped_at, users=None, queries=None, check=None):
    posts = _landed(spark, path, POST_SCHEMA, check).where(_from_day(F.col("created_at"), since))
    return scan_posts(posts, country, scraped_at, users, queries)


def _read_forms(spark: SparkSession, path, since, country, scraped_at, asset="", check=None):
    exports = _landed(spark, path, FORM_SCHEMA, check, multi_line=True)
    return scan_forms(exports, country, asset, scraped_at).where(_from_day(F.col("datetime_"), since))


READERS: dict[str, Callable[..., DataFrame]] = {
    "telegram": _read_channels,
    "twitter": _read_posts,
    "kobo": _read_forms,
}


def read_messages(
    spark: SparkSession,
    source: str,
    path: str | list[str],
    since: datetime | date | str,
    country: str,
    scraped_at: datetime | str,
    until: datetime | str | None = None,
    **options,
) -> DataFrame:
    """Messages of a landed source by its name; ``until``, when given, is exclusive.

    With a ``check=InputCheck(share)`` malformed records are counted as they are read.
    """
    if source not in READERS:
        raise ValueError(f"source {source} is not supported, use one of {', '.join(READERS)}")
    messages = READERS[source](spark, path, since, country.upper(), scraped_at, **options)
    if until is not None:
        messages = messages.where(F.col("datetime_") < F.lit(str(until)).cast("timestamp_ntz"))
    return messages
