"""The driver's tables seen as messages, raw exports and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.nested import translation
from feedlens.schema import info_struct, to_messages
from feedlens.session import estimated_bytes, lookup_table, spread

EPOCH = "2024-01-01 00:00:00"
SCRAPED_AT = "2024-02-01 12:00:00"
#: of a table, in each file that it is landed as
LANDED_BYTES = 128 << 20

# Fixed values of the fixtures.
COUNTRY_OF_LANG = {"en": "GBR", "de": "DEU", "fr": "FRA", "es": "ESP"}
EVENT_COUNTRIES = ["GBR", "DEU", "FRA", "ESP"]
KEYWORDS = ["with", "nicht", "with the"]
STOPWORDS = {
    "en": "the of and to is that it for was with",
    "de": "der die und den von zu das mit sich nicht",
    "fr": "le et les des un du une pour qui dans",
    "es": "el que y los se del las por con una",
}
LEMMAS = {"are": "be", "is": "be", "was": "be", "des": "de", "del": "de"}
LEXICON = {
    "de": {"der": "the", "und": "and"},
    "fr": {"le": "the", "et": "and"},
    "es": {"el": "the", "y": "and"},
}
POLARITY = {"with": 1, "for": 1, "nicht": -1, "no": -1}
LABEL_TERMS = {
    "water": ["the", "le", "of"],
    "shelter": ["und", "der", "with"],
    "health": ["que", "y", "et"],
}
LABELS = list(LABEL_TERMS)
GAZETTEER = [
    (1, "hation", "Mentre", 10.0, 50.0),
    (2, " Eauou ", None, 2.5, 48.5),
    (3, "heand", "hation", -1.5, 52.0),
    (4, "ierung", "", 13.0, 52.5),
    (5, None, "osc", -3.5, 40.0),
    (6, "", "è", 4.0, 44.0),
]
REGIONS = [
    (1, "rectangle", [(-180.0, 0.0), (-60.0, 0.0), (-60.0, 45.0), (-180.0, 45.0)]),
    (2, "triangle", [(-100.0, 10.0), (100.0, 10.0), (0.0, 80.0)]),
    (3, "concave", [(0.0, 0.0), (120.0, 0.0), (120.0, 60.0), (60.0, 20.0), (0.0, 60.0)]),
    (4, "overlap", [(50.0, 5.0), (170.0, 5.0), (170.0, 30.0), (50.0, 30.0)]),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed_files(spark: SparkSession, sf_dir: str, name: str) -> int:
    """As how many files a table is landed, so that no task writes more of it than about ``LANDED_BYTES``."""
    return max(1, -(-estimated_bytes(table(spark, sf_dir, name)) // LANDED_BYTES))


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows cost much work each: dealt out when the scan is too narrow."""
    return spread(table(spark, sf_dir, name), key)


HOURS = 1_000_000


def _after_epoch(hours: Column, minutes: Column | None = None) -> Column:
    """The hour of a row number; numbers start over after a million, within the range of dates."""
    mins = F.lit(0) if minutes is None else minutes.cast("int")
    shift = F.make_dt_interval(F.lit(0), F.pmod(hours, F.lit(HOURS)).cast("int"), mins)
    return F.lit(EPOCH).cast("timestamp_ntz") + shift


def _scraped() -> Column:
    return F.lit(SCRAPED_AT).cast("timestamp_ntz")


def _country_of(lang: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, country in COUNTRY_OF_LANG.items():
        out = F.when(lang == code, country).otherwise(out)
    return out


def documents(
    spark: SparkSession,
    sf_dir: str,
    with_members: bool = False,
    keep_lang: bool = False,
    heavy: bool = False,
) -> DataFrame:
    """``documents`` as messages; the member count is the number of texts of the source.

    ``heavy`` announces much work per text, worth an exchange if the scan is narrow.
    """
    docs = texts(spark, sf_dir, "documents", "doc_id") if heavy else table(spark, sf_dir, "documents")
    members = F.lit(None)
    if with_members:
        sizes = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("members"))
        docs = docs.join(sizes, "source")
        members = F.col("members")
    rows = docs.select(
        F.col("doc_id").cast("string").alias("id_"),
        _after_epoch(F.col("doc_id")).alias("datetime_"),
        _scraped().alias("datetime_scraped_"),
        _country_of(F.col("lang")).alias("country"),
        F.lit("documents").alias("source"),
        F.col("source").alias("group"),
        F.col("text"),
        info_struct(members).alias("info"),
        "lang",
    )
    messages = to_messages(rows)
    if not keep_lang:
        return messages
    lang = F.lit(None).cast("string")
    for code, country in COUNTRY_OF_LANG.items():
        lang = F.when(F.col("country") == country, code).otherwise(lang)
    return messages.withColumn("lang", lang)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as messages; each turn replies to the one before."""
    conv = table(spark, sf_dir, "conversations")
    number = F.col("conv_id") * 1000 + F.col("turn")
    return to_messages(
        conv.select(
            number.cast("string").alias("id_"),
            _after_epoch(F.col("conv_id"), F.col("turn")).alias("datetime_"),
            _scraped().alias("datetime_scraped_"),
            F.lit("NLD").alias("country"),
            F.lit("conversations").alias("source"),
            F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("group"),
            F.col("text"),
            (F.col("turn") > 0).alias("reply"),
            F.when(F.col("turn") > 0, (number - 1).cast("string")).alias("reply_to"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as messages with coordinates."""
    return events_as_messages(table(spark, sf_dir, "events"))


def events_as_messages(ev: DataFrame) -> DataFrame:
    country = F.get(F.lit(EVENT_COUNTRIES), F.pmod(F.col("user_id"), F.lit(4)).cast("int"))
    return to_messages(
        ev.select(
            F.col("event_id").cast("string").alias("id_"),
            F.col("ts").alias("datetime_"),
            _scraped().alias("datetime_scraped_"),
            country.alias("country"),
            F.lit("events").alias("source"),
            F.col("event_type").alias("group"),
            F.col("props").alias("text"),
            info_struct(lon=_lon(), lat=_lat()).alias("info"),
        )
    )


def _lon() -> Column:
    return F.pmod(F.col("user_id"), F.lit(36)) * 10 - 180 + F.lit(0.25).cast("double")


def _lat() -> Column:
    return F.pmod(F.col("value"), F.lit(90.0))


def pages(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """``pages`` as messages: title and address, with ``heavy`` the body, too; no country where the language is unknown."""
    pg = texts(spark, sf_dir, "pages", "page_id") if heavy else table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    body = [F.lit(" "), F.regexp_replace("html", "<[^>]*>", " ")] if heavy else []
    lang = F.regexp_extract("url", r"^https?://[^/]+/(en|de|fr)/", 1)
    return to_messages(
        pg.select(
            F.col("page_id").cast("string").alias("id_"),
            _after_epoch(F.col("page_id")).alias("datetime_"),
            _scraped().alias("datetime_scraped_"),
            _country_of(lang).alias("country"),
            F.lit("pages").alias("source"),
            F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("group"),
            F.concat(title, F.lit(" "), F.col("url"), *body).alias("text"),
        )
    )


def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as raw channel rows: even turns are posts, odd ones reply to them."""
    conv = table(spark, sf_dir, "conversations")
    number = F.col("conv_id") * 1000 + F.col("turn")
    is_post = F.pmod("turn", F.lit(2)) == 0
    answered = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit(1).cast("bigint").alias("replies"))
    header = F.struct((number - 1).alias("reply_to_msg_id"))
    return conv.join(answered, ["conv_id", "turn"], "left").select(
        number.alias("id"),
        _after_epoch(F.col("conv_id"), F.col("turn")).alias("date"),
        F.col("text").alias("message"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("channel"),
        F.when(~is_post, header).alias("reply_to"),
        (is_post & (F.col("role") != "system")).alias("post"),
        F.when(is_post, F.col("replies")).alias("replies"),
        (F.pmod("conv_id", F.lit(3)) != 0).alias("broadcast"),
    )


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as raw channel rows without replies."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        _after_epoch(F.col("doc_id")).alias("date"),
        F.col("text").alias("message"),
        F.col("source").alias("channel"),
        F.lit(None).cast("struct<reply_to_msg_id:bigint>").alias("reply_to"),
        F.lit(True).alias("post"),
        F.lit(None).cast("bigint").alias("replies"),
        F.lit(False).alias("broadcast"),
    )


def conversation_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    return conv.select(F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("channel"))


def channel_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(F.col("source").alias("channel")).agg(F.count("*").alias("members"))


def raw_event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as public posts; errors stand for re-shares."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
        F.col("props").alias("text"),
        (F.col("event_type") == "error").alias("is_reshare"),
        F.col("ts").alias("created_at"),
    )


def raw_document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("user"),
        F.col("text"),
        F.lit(False).alias("is_reshare"),
        _after_epoch(F.col("doc_id")).alias("created_at"),
    )


def form_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as form exports in JSON text, one record per export."""
    record = F.struct(
        F.col("doc_id").alias("_id"),
        F.date_format(_after_epoch(F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss").alias("_submission_time"),
        F.col("text"),
        F.col("source").alias("group"),
    )
    export = F.struct(F.array(record).alias("results"))
    return table(spark, sf_dir, "documents").select(F.to_json(export).alias("value"))


def faulty_channel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``channel, value``: ``documents`` as channel rows in JSON text, some cut short, some with a text for an id, some without a message."""
    rest = F.pmod("id", F.lit(10))
    rows = raw_documents(spark, sf_dir).withColumn("message", F.when(rest != 5, F.col("message")))
    line = F.to_json(F.struct(*rows.columns))
    cut = F.expr("left(line, length(line) - 1)")
    wrong = F.regexp_replace("line", '"id":[0-9]+', '"id":"x"')
    lines = rows.select(F.coalesce("channel", F.lit("none")).alias("channel"), line.alias("line"), rest.alias("rest"))
    return lines.select("channel", F.when(F.col("rest") == 3, cut).when(F.col("rest") == 7, wrong).otherwise(F.col("line")).alias("value"))


def translated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that carry a reversed text as translation from their language to English."""
    docs = documents(spark, sf_dir, keep_lang=True)
    entry = translation(F.reverse("text"), F.col("lang"), F.lit("en"))
    return docs.withColumn("translations", F.when(F.col("lang") != "en", F.array(entry)).otherwise(F.col("translations")))


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return lookup_table(spark, rows, schema)


def stopwords(spark: SparkSession) -> DataFrame:
    rows = [(lang, word) for lang, text in STOPWORDS.items() for word in text.split()]
    return _rows(spark, rows, "lang string, word string")


def lemmas(spark: SparkSession) -> DataFrame:
    return _rows(spark, list(LEMMAS.items()), "word string, lemma string")


def lexicon(spark: SparkSession) -> DataFrame:
    rows = [(lang, "en", w, t) for lang, entries in LEXICON.items() for w, t in entries.items()]
    return _rows(spark, rows, "from_lang string, to_lang string, word string, translation string")


def polarity(spark: SparkSession) -> DataFrame:
    return _rows(spark, list(POLARITY.items()), "word string, sign int")


def label_terms(spark: SparkSession) -> DataFrame:
    rows = [(label, term) for label, terms in LABEL_TERMS.items() for term in terms]
    return _rows(spark, rows, "label string, term string")


def gazetteer(spark: SparkSession) -> DataFrame:
    return _rows(spark, GAZETTEER, "loc_id int, name string, name_alt string, lon double, lat double")


def regions(spark: SparkSession) -> DataFrame:
    return _rows(spark, REGIONS, "region_id int, name string, ring array<struct<x:double,y:double>>")


def activity_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One five-cornered region per user of ``events``, around its points."""
    ev = table(spark, sf_dir, "events").select("user_id", _lon().alias("lon"), _lat().alias("lat"))
    spans = ev.groupBy("user_id", "lon").agg(F.min("lat").alias("low"), F.max("lat").alias("high"))
    lon, low, high = F.col("lon"), F.col("low"), F.col("high")

    def point(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(
        point(lon - 1.0, low),
        point(lon + 1.0, low),
        point(lon + 1.0, high),
        point(lon, high + 1.0),
        point(lon - 1.0, high),
    )
    return spans.select(F.col("user_id").alias("region_id"), ring.alias("ring"))


def region_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``activity_regions`` as GeoJSON, one polygon a line."""
    pairs = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("User "), F.col("region_id").cast("string")).alias("name")).alias("properties"),
        F.struct(
            F.lit("Polygon").alias("type"), F.array(F.concat(pairs, F.slice(pairs, 1, 1))).alias("coordinates")
        ).alias("geometry"),
    )
    return activity_regions(spark, sf_dir).select(F.to_json(feature).alias("value"))


def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of ``documents`` in order, as a label dictionary in JSON text."""
    names = table(spark, sf_dir, "documents").agg(F.array_sort(F.collect_set("source")).alias("names"))
    entries = F.transform("names", lambda name, i: F.struct(i.cast("string"), name))
    return names.select(F.to_json(F.map_from_entries(entries)).alias("value"))


def review_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers derived from ``labels``: a good text is submitted, a bad one discarded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").join(docs, "doc_id")
    good = F.col("quality") == 1
    first = F.when(F.col("n_chars") > 400, "water").otherwise("shelter")
    topics = F.when(F.col("toxic") == 1, F.array(first, F.lit("health"))).otherwise(F.array(first))
    country = _country_of(F.col("lang"))
    return lab.select(
        F.lower(country).alias("workspace"),
        F.concat(country, F.lit("-2024-01-01-2024-02-01")).alias("dataset"),
        F.col("doc_id").cast("string").alias("external_id"),
        F.when(good, "submitted").otherwise("discarded").alias("status"),
        F.when(good, topics).alias("topics"),
        F.when(F.col("toxic") == 1, F.lit("[redacted]")).alias("anonymization"),
        F.when(F.col("n_chars") > 2000, F.lit("revised")).alias("translation"),
    )
