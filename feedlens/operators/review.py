"""Review round trip: records for human reviewers, and their answers back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions.nested import (
    classification,
    first_translation,
    top_model_classification,
    translation,
)
from feedlens.functions.text import has_text
from feedlens.operators.dedupe import arrival_order, first_per_key
from feedlens.operators.joins import TEXT_KEY, with_text_key
from feedlens.operators.keywords import keyword_flag
from feedlens.operators.numbering import number_rows
from feedlens.schema import ISO_FORMAT, info_struct, parse_datetime

RECORD_KEY = ["workspace", "dataset", "external_id"]


def review_export(
    messages: DataFrame,
    keywords: DataFrame | list[str],
    dataset: Column | str,
    workspace: Column | str | None = None,
) -> DataFrame:
    """One review record per distinct non-empty text.

    Copies of a text are dropped over all messages; numbers count the distinct
    texts of a data set in arrival order, empty ones included, which leaves gaps.
    Texts are told apart by two 64-bit hashes, and copies that arrive together by
    their columns. The messages are read twice, once for the numbers, where only
    times, ids, names and hashes are exchanged and written; where an engine has
    enriched them they should be stored first, as ``run_listening`` does.
    """
    space = F.lower(F.col("country") if workspace is None else F.lit(workspace) if isinstance(workspace, str) else workspace)
    name = F.lit(dataset) if isinstance(dataset, str) else dataset
    told_apart = [*arrival_order(), F.col("source").asc(), F.col("country").asc(), F.col("group").asc()]
    named = with_text_key(messages, F.col("text")).withColumns({"workspace": space, "dataset": name})
    unique = first_per_key(named, TEXT_KEY, [*told_apart, F.col("dataset").asc(), F.col("workspace").asc()])
    by_hash = [F.col(c).asc() for c in TEXT_KEY]
    numbered = number_rows(unique, ["workspace", "dataset"], [*told_apart, *by_hash], row_key=TEXT_KEY)
    flagged = keyword_flag(numbered.where(has_text(F.col("text"))).drop(*TEXT_KEY), keywords)
    translations = F.col("translations")
    return flagged.select(
        "workspace",
        "dataset",
        F.col("id_").alias("external_id"),
        F.col("text").alias("text_original"),
        first_translation(translations, "text").alias("text_translated"),
        top_model_classification(F.col("classifications")).alias("suggestion"),
        F.struct(
            F.col("group"),
            F.col("info.group_members").alias("group_members"),
            F.col("source"),
            F.col("number"),
            F.when(F.col("keyword_flag"), "Yes").otherwise("No").alias("keyword_flag"),
            first_translation(translations, "from_lang").alias("translation_from_lang"),
            first_translation(translations, "to_lang").alias("translation_to_lang"),
            F.date_format("datetime_", ISO_FORMAT).alias("datetime"),
            F.date_format("datetime_scraped_", ISO_FORMAT).alias("datetime_scraped"),
            F.col("country"),
        ).alias("metadata"),
    )


def answered(records: DataFrame, answers: DataFrame) -> DataFrame:
    """Records with their answer columns; null where nobody has answered."""
    return records.join(answers, RECORD_KEY, "left")


def submitted_only(with_answers: DataFrame) -> DataFrame:
    """Drop records that are unanswered or discarded."""
    return with_answers.where(F.col("status").isNotNull() & (F.col("status") != "discarded"))


def first_records(records: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` records of each data set, by number.

    The rows are ranked where they lie; a top-n operator would gather all of
    them in one task.
    """
    order = [F.col("metadata.number").asc(), F.col("external_id").asc()]
    ranked = number_rows(records, ["workspace", "dataset"], order, "_nth")
    return ranked.where(F.col("_nth") <= limit).drop("_nth")


def review_import(
    records: DataFrame, answers: DataFrame, only_submitted: bool = False, limit: int | None = None
) -> DataFrame:
    """Messages rebuilt from review records.

    The reviewer's translation replaces the exported one; the model suggestion is
    followed by one human classification of score 1.0 per submitted label.
    """
    joined = answered(records if limit is None else first_records(records, limit), answers)
    if only_submitted:
        joined = submitted_only(joined)
    meta = F.col("metadata")
    exported = F.col("text_translated")
    revised = F.when(has_text(F.col("translation")), F.col("translation")).otherwise(exported)
    entry = translation(revised, meta["translation_from_lang"], meta["translation_to_lang"])
    no_translation = F.array().cast("array<struct<text:string,from_lang:string,to_lang:string>>")
    none = F.array().cast("array<struct<topic:string,score:double,agent:string>>")
    by_model = F.when(F.col("suggestion").isNotNull(), F.array("suggestion")).otherwise(none)
    human = F.transform("topics", lambda t: classification(t, F.lit(1.0), F.lit("human")))
    by_human = F.when((F.col("status") == "submitted") & F.col("topics").isNotNull(), human).otherwise(none)
    return joined.select(
        F.col("external_id").alias("id_"),
        parse_datetime(meta["datetime"]).alias("datetime_"),
        parse_datetime(meta["datetime_scraped"]).alias("datetime_scraped_"),
        meta["country"].alias("country"),
        meta["source"].alias("source"),
        meta["group"].alias("group"),
        F.col("text_original").alias("text"),
        F.lit(False).alias("reply"),
        F.lit(None).cast("string").alias("reply_to"),
        F.when(exported != "", F.array(entry)).otherwise(no_translation).alias("translations"),
        info_struct(meta["group_members"]).alias("info"),
        F.concat(by_model, by_human).alias("classifications"),
    )


def apply_anonymization(records: DataFrame, answers: DataFrame) -> DataFrame:
    """``text`` is the reviewer's rewriting where there is one, else the original."""
    joined = answered(records, answers)
    rewritten = F.when(has_text(F.col("anonymization")), F.col("anonymization"))
    return joined.select(*RECORD_KEY, F.coalesce(rewritten, F.col("text_original")).alias("text"))


def agreement(records: DataFrame, answers: DataFrame) -> DataFrame:
    """How often each suggested topic met each submitted one. Unsuggested records count under null."""
    done = answered(records, answers).where(F.col("status") == "submitted")
    return (
        done.select(F.col("suggestion.topic").alias("suggested"), F.explode("topics").alias("human"))
        .groupBy("suggested", "human")
        .agg(F.count("*").alias("records"))
        .withColumn("agree", F.col("suggested").eqNullSafe(F.col("human")))
    )
