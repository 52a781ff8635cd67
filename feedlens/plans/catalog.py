"""Every operator as a query over the driver's tables, with flat result columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions import nested
from feedlens.functions.codec import message_json
from feedlens.functions.geometry import bounding_box, centroid
from feedlens.functions.redact import KINDS, placeholder_count, redact
from feedlens.functions.text import clean_text
from feedlens.operators import anonymize as anon
from feedlens.operators import classify, compare, dedupe, filters, geo, keywords, language
from feedlens.operators import review, threads, topics, translate, wordfreq
from feedlens.operators.totals import StageTotals
from feedlens.plans import testtables as tt
from feedlens.plans.pipeline import dataset_column, enrich
from feedlens.schema import info_struct
from feedlens.session import cut_lineage, lookup_table, scratch_dir, tune
from feedlens.sources import files, gazetteer, raw
from feedlens.sources.labels import label_table
from feedlens.sources.reviewset import decode_metadata, read_review_set, write_review_set
from feedlens.sources.store import MessageStore
from feedlens.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-01-30 12:00:00"
SPLIT_STORED = "2024-01-20 00:00:00"
SPLIT_NEW = "2024-01-11 00:00:00"
DOC_KEY = ["id_"]


def query(fn: Query | None = None, name: str | None = None):
    """Registers a query, under its own name or another one."""
    if fn is None:
        return functools.partial(query, name=name)

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[name or fn.__name__] = run
    return run


def _spread(df: DataFrame, keep: list, array: str, name: str) -> DataFrame:
    """One row per array element with its index.

    The outer form is used and its null rows dropped: for the inner one Catalyst
    adds a filter on the array's size, pushes it down to the scan and so computes
    the array twice.
    """
    spread = df.select(*keep, F.posexplode_outer(array).alias("ix", name))
    return spread.where("ix is not null").withColumn("ix", F.col("ix").cast("bigint"))


def _channel() -> Column:
    return F.col("group").alias("channel")


def _members() -> Column:
    return F.col("info.group_members").alias("group_members")


# --- scans -------------------------------------------------------------------


@query
def scan_channel_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = tt.channel_members(spark, sf_dir)
    found = raw.scan_channels(
        tt.raw_documents(spark, sf_dir), members, "2024-01-08", "GBR", tt.SCRAPED_AT, members
    )
    return found.select("id_", "datetime_", "country", "source", _channel(), "text", "reply", _members())


@query
def scan_posts_with_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tt.raw_channels(spark, sf_dir)
    found = raw.scan_channels(
        rows, tt.conversation_channels(spark, sf_dir), "2024-01-02", "NLD", tt.SCRAPED_AT, with_replies=True
    )
    return found.select("id_", "datetime_", _channel(), "text", "reply", "reply_to")


@query
def scan_user_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    followed = tt.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    users = followed.select(F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("user"))
    found = raw.scan_posts(tt.raw_event_posts(spark, sf_dir), "NLD", tt.SCRAPED_AT, users=users)
    return found.select("id_", "datetime_", _channel(), "text")


@query
def scan_search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = tt.table(spark, sf_dir, "benchmark").select(F.col("text").alias("query"))
    found = raw.scan_posts(tt.raw_document_posts(spark, sf_dir), "NLD", tt.SCRAPED_AT, queries=queries)
    return found.select("id_", "datetime_", _channel(), "text")


@query
def scan_form_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = scratch_dir(spark, "forms")
    tt.form_exports(spark, sf_dir).write.text(landed)
    exports = raw.read_json(spark, landed, raw.FORM_SCHEMA)
    found = raw.scan_forms(exports, "UKR", "asset-1", tt.SCRAPED_AT)
    asset = F.col("info.extra")["kobo_asset"].alias("kobo_asset")
    return found.select("id_", "datetime_", "country", "source", _channel(), "text", asset)


@query
def scan_bad_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, malformed and empty records of landed exports, counted by file and added up by channel."""
    landed = scratch_dir(spark, "faulty")
    tt.faulty_channel_rows(spark, sf_dir).write.partitionBy("channel").text(landed)
    records = raw.read_records(spark, landed, raw.CHANNEL_SCHEMA)
    account = raw.input_account(records, F.coalesce(F.col("record.message"), F.lit("")) == "")
    by_channel = account.groupBy(F.regexp_extract("file", "channel=([^/]*)/", 1).alias("channel"))
    return by_channel.agg(*[F.sum(c).alias(c) for c in ("records", "good", "malformed", "empty")])


@query
def scan_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions landed as GeoJSON, read back with their centroids."""
    landed = scratch_dir(spark, "features")
    tt.region_features(spark, sf_dir).write.text(landed)
    places = gazetteer.read_features(spark, landed, ["name"])
    return places.select(
        "name", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
        F.size(F.flatten("rings")).cast("bigint").alias("points"),
    )


@query
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class indexes of all documents, named by a label dictionary that is landed as JSON."""
    landed = scratch_dir(spark, "labels")
    tt.source_labels(spark, sf_dir).write.text(landed)
    indexed = tt.table(spark, sf_dir, "documents").select("doc_id", F.pmod("doc_id", F.lit(3)).cast("int").alias("ix"))
    return indexed.join(label_table(spark, landed), "ix").select("doc_id", "label")


@query
def nan_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of events, those of errors given as values that are no numbers: such a message has no point."""
    ev = tt.table(spark, sf_dir, "events")
    lat = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.pmod("value", F.lit(90.0)))
    points = ev.select(F.col("event_id").cast("string").alias("id_"), info_struct(lon=F.lit(0.25), lat=lat).alias("info"))
    return points.select("id_", F.col("info.coordinates.lon").alias("lon"), F.round("info.coordinates.lat", 6).alias("lat"))


@query
def normalize_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tt.raw_channels(spark, sf_dir)
    members = rows.groupBy("channel").agg(F.count("*").alias("members"))
    found = raw.normalize_channel_rows(rows, "NLD", tt.SCRAPED_AT, members)
    return found.select(
        "id_", "datetime_", "datetime_scraped_", "country", "source", _channel(), "text", "reply",
        "reply_to", _members(), F.size("translations").cast("bigint").alias("translations"),
    )


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(tt.translated_documents(spark, sf_dir).drop("lang"), scratch_dir(spark, "csv"))
    back = files.read_csv(spark, path)
    return back.select(
        "id_", "datetime_", "country", _channel(), "text", "reply",
        F.size("translations").cast("bigint").alias("translations"),
        nested.first_translation(F.col("translations"), "text").alias("translated"),
    )


@query
def csv_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of all documents, one up to ``LANDED_BYTES``, with their line breaks, read in byte ranges."""
    n = tt.landed_files(spark, sf_dir, "documents")
    rows = tt.translated_documents(spark, sf_dir).drop("lang").coalesce(n)
    back = files.read_csv(spark, files.write_csv(rows, scratch_dir(spark, "csv")), in_ranges=True)
    return back.select(
        "id_", "datetime_", "country", _channel(), "text", "reply",
        F.size("translations").cast("bigint").alias("translations"),
        nested.first_translation(F.col("translations"), "text").alias("translated"),
    )


@query
def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intermediate result of an extraction, saved under its source and dates and read again."""
    folder = scratch_dir(spark, "snapshots")
    path = files.save_snapshot(tt.documents(spark, sf_dir), folder, "documents", "2024-01-01", "2024-02-01")
    back = files.read_csv(spark, path)
    return back.select("id_", "datetime_", "country", _channel(), "text")


def _filled_store(spark: SparkSession, sf_dir: str) -> MessageStore:
    store = MessageStore(spark, scratch_dir(spark, "store"))
    store.append(tt.documents(spark, sf_dir).unionByName(tt.conversations(spark, sf_dir)))
    return store


@query
def scan_store_required_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _filled_store(spark, sf_dir).read_required(
        "2024-01-02 00:00:00", "2024-01-20 05:00:00", "FRA", "documents"
    )
    return found.select("id_", "datetime_", "country", "source", _channel(), "text")


@query
def scan_store_optional_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _filled_store(spark, sf_dir).read(end="2024-01-15 08:00:00", country="NLD")
    return found.select("id_", "datetime_", "country", "source", _channel(), "text", "reply", "reply_to")


# --- filters, bounds, counts ---------------------------------------------------


@query
def filter_min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.min_length(tt.documents(spark, sf_dir))
    return kept.select("id_", "text", F.length("text").cast("bigint").alias("n"))


@query
def filter_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.since(tt.events(spark, sf_dir), AS_OF, 14).select("id_", "datetime_", "country")


@query
def null_guard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tt.documents(spark, sf_dir).unionByName(tt.pages(spark, sf_dir))
    return filters.null_counts(both)


@query
def batch_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tt.documents(spark, sf_dir).unionByName(tt.events(spark, sf_dir))
    return dedupe.batch_bounds(both)


@query
def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tt.documents(spark, sf_dir).unionByName(tt.pages(spark, sf_dir))
    return dedupe.channel_counts(both).withColumnRenamed("group", "channel")


# --- dedupe, insert, upsert ----------------------------------------------------


@query
def dedupe_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = tt.pages(spark, sf_dir, heavy=True)
    both = tt.documents(spark, sf_dir).unionByName(whole).unionByName(tt.conversations(spark, sf_dir))
    kept = dedupe.first_per_key(both, order=[F.col("datetime_"), F.col("source")])
    return kept.select("id_", "source", "datetime_", "text")


@query
def dedupe_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_per_text(tt.documents(spark, sf_dir)).select("id_", "text")


def _stored_and_incoming(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A store filled up to one day and a re-scan from an earlier one, errors delivered twice.

    Nothing of Spain is stored yet.
    """
    ev = tt.events(spark, sf_dir)
    stored = ev.where((F.col("datetime_") < F.lit(SPLIT_STORED).cast("timestamp_ntz")) & (F.col("country") != "ESP"))
    again = ev.where(F.col("datetime_") >= F.lit(SPLIT_NEW).cast("timestamp_ntz"))
    return stored, again.unionByName(again.where("`group` = 'error'"))


@query
def insert_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return dedupe.new_rows(incoming, stored).select("id_", "datetime_", "country", "source", _channel(), "text")


@query
def insert_new_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return dedupe.new_rows_strict(incoming, stored).select("id_", "datetime_", "country", "source", _channel(), "text")


@query
def insert_new_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    return dedupe.insert_counts(incoming, dedupe.new_rows(incoming, stored))


def _edited(messages: DataFrame) -> DataFrame:
    """A later scrape of the same messages, with an edited text."""
    return messages.withColumns(
        {
            "text": F.concat(F.lit("edited "), F.col("text")),
            "datetime_scraped_": F.col("datetime_scraped_") + F.expr("INTERVAL '1' DAY"),
        }
    )


@query
def upsert_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _stored_and_incoming(spark, sf_dir)
    store = MessageStore(spark, scratch_dir(spark, "upsert"))
    store.append(stored)
    store.upsert(incoming.unionByName(_edited(incoming.where("`group` = 'error'"))))
    return store.all().select("id_", "datetime_", "datetime_scraped_", "country", _channel(), "text")


@query(name="message_json")
def message_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tt.translated_documents(spark, sf_dir).drop("lang")
    return rows.select("id_", message_json().alias("json"))


@query
def message_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a reload that lost the short ones and was cleaned."""
    left = tt.documents(spark, sf_dir, heavy=True)
    reloaded = filters.min_length(left, 200).withColumn("text", clean_text(F.col("text")))
    right = reloaded.unionByName(tt.conversations(spark, sf_dir))
    fields = ["datetime_", "country", "group", "text", "reply_to"]
    return compare.message_diff(left, right, ["source", "id_"], fields)


# --- threads -------------------------------------------------------------------


@query
def thread_reply_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = threads.thread_reply_counts(tt.conversations(spark, sf_dir))
    return counted.select("id_", _channel(), "datetime_", "replies", "last_reply")


# --- words ---------------------------------------------------------------------


@query
def word_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordfreq.word_frequency(tt.documents(spark, sf_dir, heavy=True), tt.stopwords(spark), tt.lemmas(spark))


@query
def word_frequency_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordfreq.word_frequency(tt.documents(spark, sf_dir, heavy=True), tt.stopwords(spark), by=["country"])


@query
def word_frequency_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordfreq.most_frequent(word_frequency(spark, sf_dir), 50)


@query
def word_frequency_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the German documents, the only ones this lexicon is for, counted and then translated."""
    german = tt.documents(spark, sf_dir, heavy=True).where("country = 'DEU'")
    none = tt.stopwords(spark).where(F.lit(False))
    counted = wordfreq.word_frequency(german, none, tt.lemmas(spark))
    return wordfreq.translate_words(counted, tt.lexicon(spark), "de", "en")


@query
def lemma_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordfreq.lemmatize(wordfreq.word_counts(tt.documents(spark, sf_dir, heavy=True)), tt.lemmas(spark))


@query
def keyword_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = keywords.keyword_flag(tt.documents(spark, sf_dir, heavy=True), tt.KEYWORDS)
    return flagged.select("id_", "keyword_flag")


@query
def keyword_flag_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flag from a keyword table too long for one pattern: here every benchmark text too."""
    listed = lookup_table(spark, [(k,) for k in tt.KEYWORDS], "keyword string")
    table = listed.unionByName(tt.table(spark, sf_dir, "benchmark").select(F.col("text").alias("keyword")))
    flagged = keywords.keyword_flag(tt.documents(spark, sf_dir, heavy=True), table, max_inline=0)
    return flagged.select("id_", "keyword_flag")


@query(name="clean_text")
def clean_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tt.documents(spark, sf_dir, heavy=True).unionByName(tt.pages(spark, sf_dir, heavy=True))
    return both.select("source", "id_", clean_text(F.col("text")).alias("cleaned"))


@query
def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.detect_language(tt.documents(spark, sf_dir, heavy=True), tt.stopwords(spark))
    return found.select("id_", "detected_lang")


@query
def detect_language_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vote by the join that serves long stop-word tables."""
    found = language.detect_language(tt.documents(spark, sf_dir, heavy=True), tt.stopwords(spark), max_inline=0)
    return found.select("id_", "detected_lang")


@query
def detect_language_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.detect_language(tt.documents(spark, sf_dir, keep_lang=True, heavy=True), tt.stopwords(spark))
    return language.language_confusion(found)


# --- translation ---------------------------------------------------------------


def _translate(messages: DataFrame, max_inline: int = translate.MAX_INLINE_LEXICON) -> DataFrame:
    spark = messages.sparkSession
    return translate.translate_with_lexicon(
        messages, tt.lexicon(spark), "", "en", tt.stopwords(spark), max_inline=max_inline
    )


def _exploded_translations(messages: DataFrame) -> DataFrame:
    spread = _spread(messages, ["id_"], "translations", "t")
    return spread.select("id_", "ix", "t.from_lang", "t.to_lang", "t.text")


@query
def translate_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded_translations(_translate(tt.documents(spark, sf_dir, heavy=True)))


@query
def translate_lexicon_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same translation by the join that serves long lexicons."""
    return _exploded_translations(_translate(tt.documents(spark, sf_dir, heavy=True), max_inline=0))


def _reversing_engine(source: str, target: str):
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"text": texts.str[::-1], "lang": "xx"})

    return run


@query
def translate_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = translate.translate_with_engine(tt.documents(spark, sf_dir, heavy=True), _reversing_engine, "", "en", pause=0.0)
    return _exploded_translations(done)


def _failing_engine(source: str, target: str):
    """An engine that refuses a batch with any text whose length is a multiple of 97."""

    def run(texts: pd.Series) -> pd.DataFrame:
        if (texts.str.len() % 97 == 0).any():
            raise ValueError("refused")
        return pd.DataFrame({"text": texts.str[::-1], "lang": "xx"})

    return run


@query
def translate_udf_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that an engine refuses stay as they are; the others of their batches are translated."""
    docs = tt.documents(spark, sf_dir, heavy=True)
    done = translate.translate_with_engine(docs, _failing_engine, "", "en", tries=2, pause=0.0, failed="failed")
    return done.select("id_", "failed", F.element_at("translations", -1)["text"].alias("text"))


@query
def translation_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set the (fr, en) translation: replaced where it exists, appended elsewhere."""
    docs = tt.translated_documents(spark, sf_dir)
    new = nested.translation(F.concat(F.lit("NEW "), F.col("text")), F.lit("fr"), F.lit("en"))
    return _exploded_translations(docs.withColumn("translations", nested.set_translation(F.col("translations"), new)))


@query
def text_for_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tt.translated_documents(spark, sf_dir)
    return docs.select(
        "id_", classify.text_to_classify("en").alias("text_en"), classify.text_to_classify(None).alias("text_any")
    )


# --- classification --------------------------------------------------------------


def _exploded_classifications(messages: DataFrame) -> DataFrame:
    spread = _spread(messages, ["id_"], "classifications", "c")
    return spread.select("id_", "ix", "c.topic", F.round("c.score", 6).alias("score"), "c.agent")


def _classify(messages: DataFrame) -> DataFrame:
    return classify.classify_labels(messages, tt.label_terms(messages.sparkSession), tt.LABELS)


@query
def classify_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded_classifications(classify.classify_sentiment(tt.documents(spark, sf_dir, heavy=True), tt.polarity(spark)))


@query
def classify_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded_classifications(_classify(tt.documents(spark, sf_dir, heavy=True)))


@query
def classify_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify.centroid_scores(tt.table(spark, sf_dir, "embeddings"), list(range(10)))
    spread = _spread(scored, ["vec_id"], "scores", "s")
    return spread.select("vec_id", F.col("s.label").alias("label"), F.round("s.score", 6).alias("score"))


@query
def classify_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tt.texts(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")
    labelled = tt.table(spark, sf_dir, "labels").join(docs, "doc_id").select("text", F.col("quality").alias("label"))
    model = classify.fit_topics(labelled)
    return _exploded_classifications(classify.classify_trained(tt.documents(spark, sf_dir, heavy=True), model, ["bad", "good"]))


@query
def classify_trained_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any trained model: one entry per class, in index order with its label, scores that sum to 1."""
    rows = classify_trained(spark, sf_dir)
    return rows.groupBy("id_").agg(
        F.count("*").alias("entries"), F.round(F.sum("score"), 3).alias("total"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "topic"))), lambda e: e["topic"]), ",").alias("topics"),
    )


@query
def top_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties are frequent here: several labels often have all their terms in a text."""
    human = F.array(nested.classification(F.lit("human topic"), F.lit(2.0), F.lit("human")))
    docs = _classify(tt.documents(spark, sf_dir, heavy=True))
    docs = docs.withColumn("classifications", nested.add_classifications(human, F.col("classifications")))
    best = nested.top_model_classification(F.col("classifications"))
    return docs.select("id_", best["topic"].alias("topic"), F.round(best["score"], 6).alias("score"))


@query
def topic_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = classify.classify_sentiment(_classify(tt.documents(spark, sf_dir, heavy=True)), tt.polarity(spark))
    certain = F.filter("classifications", lambda c: c["score"] > 0)
    return topics.topic_vocabulary(docs.withColumn("classifications", certain), ["unused"])


# --- places ----------------------------------------------------------------------

PLACE_FIELDS = ["name", "name_alt"]


def _typed_hits(hits: DataFrame) -> DataFrame:
    return hits.select("id_", "field_ix", "loc_id", "name", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query
def geo_text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_hits(geo.match_place_names(tt.documents(spark, sf_dir, heavy=True), tt.gazetteer(spark), PLACE_FIELDS))


@query
def geo_text_match_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = geo.match_place_names(
        tt.documents(spark, sf_dir, heavy=True), tt.gazetteer(spark), PLACE_FIELDS, force_shuffle=True
    )
    return _typed_hits(hits)


@query
def geo_point_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_hits(geo.match_regions(tt.events(spark, sf_dir), tt.regions(spark)))


@query
def geo_point_in_region_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_hits(geo.match_regions(tt.events(spark, sf_dir), tt.regions(spark), force_grid=True))


@query
def region_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = tt.activity_regions(spark, sf_dir)
    middle, box = centroid(F.col("ring")), bounding_box(F.col("ring"))
    return rings.select(
        "region_id",
        F.round(middle["x"], 6).alias("lon"),
        F.round(middle["y"], 6).alias("lat"),
        F.round(box["y0"], 6).alias("low"),
        F.round(box["y1"], 6).alias("high"),
    )


def _exploded_locations(messages: DataFrame) -> DataFrame:
    spread = _spread(messages, ["source", "id_"], "info.locations", "l")
    return spread.select(
        "source", "id_", "ix", "l.name",
        F.round("l.longitude", 6).alias("lon"), F.round("l.latitude", 6).alias("lat"),
    )


def _geolocate(messages: DataFrame) -> DataFrame:
    spark = messages.sparkSession
    return geo.geolocate(messages, tt.gazetteer(spark), PLACE_FIELDS, tt.regions(spark))


@query
def geolocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tt.events(spark, sf_dir).unionByName(tt.documents(spark, sf_dir, heavy=True))
    return _exploded_locations(_geolocate(both))


# --- anonymisation -----------------------------------------------------------------


@query
def anonymize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = tt.documents(spark, sf_dir, heavy=True).unionByName(tt.pages(spark, sf_dir, heavy=True))
    return anon.anonymize(both).select("source", "id_", "text")


@query
def anonymize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    redacted = tt.documents(spark, sf_dir, heavy=True).select(redact(F.col("text")).alias("text"))
    found = [F.struct(F.lit(k).alias("kind"), placeholder_count(F.col("text"), k).alias("n")) for k in KINDS]
    counted = redacted.select(F.inline(F.array(*found))).groupBy("kind")
    return counted.agg(F.sum("n").alias("matches"), F.count_if(F.col("n") > 0).alias("messages"))


@query
def anonymize_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English messages have no translation and are redacted themselves, the others in their translation."""
    docs = _translate(tt.documents(spark, sf_dir, heavy=True))
    english = F.col("country").eqNullSafe(F.lit("GBR"))
    none = F.filter("translations", lambda t: F.lit(False))
    docs = docs.withColumn("translations", F.when(english, none).otherwise(F.col("translations")))
    return anon.anonymize(docs, "en").select("id_", "text", nested.first_translation(F.col("translations"), "text").alias("translated"))


# --- chain and review ----------------------------------------------------------------


@query
def enrich_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = filters.min_length(filters.non_empty(tt.documents(spark, sf_dir, heavy=True)))
    done = enrich(ready, _translate, _classify, _geolocate, anon.anonymize)
    best = nested.top_model_classification(F.col("classifications"))
    return done.select(
        "id_", "text",
        nested.first_translation(F.col("translations"), "text").alias("translated"),
        nested.first_translation(F.col("translations"), "from_lang").alias("from_lang"),
        best["topic"].alias("topic"),
        F.size("classifications").cast("bigint").alias("classifications"),
        F.size("info.locations").cast("bigint").alias("locations"),
    )


@query
def stage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that leave each stage of the chain, counted by the one action that writes its result."""
    totals = StageTotals()
    extracted = totals.watch(tt.documents(spark, sf_dir, heavy=True), "extract")
    kept = totals.watch(filters.min_length(filters.non_empty(extracted)), "filter")
    done = enrich(kept, _translate, _classify, anonymize=anon.anonymize, totals=totals)
    cut_lineage(totals.watch(done, "processed"))
    rows = [(i, stage, n) for i, (stage, n) in enumerate(totals.counts().items())]
    return lookup_table(spark, rows, "ix bigint, stage string, messages bigint")


def _review_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(_translate(tt.documents(spark, sf_dir, with_members=True, heavy=True)))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = dataset_column("2024-01-01", "2024-02-01")
    return review.review_export(_review_messages(spark, sf_dir), tt.KEYWORDS, dataset)


@query
def review_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        "workspace", "dataset", "external_id", "text_original", "text_translated",
        F.col("suggestion.topic").alias("topic"), F.round("suggestion.score", 6).alias("score"),
        F.col("metadata.group").alias("channel"), "metadata.group_members", "metadata.source",
        "metadata.number", "metadata.keyword_flag", "metadata.translation_from_lang",
        "metadata.translation_to_lang", "metadata.datetime", "metadata.country",
    )


@query
def review_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("workspace", "dataset", "external_id", "metadata.number")


@query
def review_set_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All review sets written, one of them read again by its name."""
    path = scratch_dir(spark, "sets")
    write_review_set(_records(spark, sf_dir), path)
    back = read_review_set(spark, path, "GBR-2024-01-01-2024-02-01", "GBR")
    return back.select("workspace", "dataset", "external_id", "text_original", "metadata.number")


@query
def metadata_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of all review records, stored as JSON text and decoded."""
    records = _records(spark, sf_dir)
    kind = records.schema["metadata"].dataType
    back = decode_metadata(records.withColumn("metadata", F.to_json("metadata")), kind)
    return back.select(
        "external_id", "metadata.number", "metadata.keyword_flag", F.col("metadata.group").alias("channel"),
        "metadata.group_members", "metadata.datetime",
    )


@query
def review_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = review.review_import(_records(spark, sf_dir), tt.review_answers(spark, sf_dir))
    spread = back.select(
        "id_", "datetime_", "country", _channel(), "text", _members(),
        nested.first_translation(F.col("translations"), "text").alias("translated"),
        F.posexplode_outer("classifications").alias("ix", "c"),
    )
    return spread.select(
        "id_", "datetime_", "country", "channel", "text", "group_members", "translated",
        F.col("ix").cast("bigint").alias("ix"), "c.topic", F.round("c.score", 6).alias("score"), "c.agent",
    )


@query
def review_only_submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = review.review_import(_records(spark, sf_dir), tt.review_answers(spark, sf_dir), only_submitted=True)
    human = F.size(F.filter("classifications", lambda c: c["agent"] == "human")).cast("bigint")
    return back.select("id_", "country", human.alias("human_labels"))


@query
def review_apply_anonymization(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = review.apply_anonymization(_records(spark, sf_dir), tt.review_answers(spark, sf_dir))
    return done.select("workspace", "external_id", "text")


@query
def review_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.agreement(_records(spark, sf_dir), tt.review_answers(spark, sf_dir))


@query
def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records of each data set, by number."""
    kept = review.first_records(_records(spark, sf_dir), limit=5)
    return kept.select("workspace", "dataset", "external_id", F.col("metadata.number").cast("bigint").alias("number"))


# --- streams -----------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` arriving as files, read as a stream of messages."""
    schema = tt.table(spark, sf_dir, "events").schema
    rows = streams.stream_files(spark, sf_dir, schema, "parquet", glob="events.parquet")
    return tt.events_as_messages(rows)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON landed in several files, ingested in micro-batches of two files."""
    landed, out = scratch_dir(spark, "landed"), scratch_dir(spark, "ingested")
    n = max(4, tt.landed_files(spark, sf_dir, "documents"))
    tt.raw_documents(spark, sf_dir).repartition(n, "id").write.json(landed)
    rows = streams.stream_files(spark, landed, raw.CHANNEL_SCHEMA, max_files=2)
    messages = filters.non_empty(raw.normalize_channel_rows(rows, "GBR", tt.SCRAPED_AT))
    streams.write_stream(messages, out, f"{out}-progress").awaitTermination()
    return spark.read.parquet(out).select("id_", "datetime_", "country", "source", _channel(), "text")


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "deduped")
    arriving = _event_stream(spark, sf_dir)
    twice = arriving.unionByName(arriving)
    streams.write_stream(streams.dedupe_stream(twice, "40 days"), out, f"{out}-progress").awaitTermination()
    return spark.read.parquet(out).select("id_", "datetime_", "country", _channel(), "text")


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = _stored_and_incoming(spark, sf_dir)
    path = scratch_dir(spark, "stream-store")
    store = MessageStore(spark, path)
    store.append(stored)
    edited = _edited(_event_stream(spark, sf_dir))
    streams.upsert_stream(edited, store, f"{path}-progress").awaitTermination()
    return store.all().select("id_", "datetime_", "datetime_scraped_", "country", _channel(), "text")
