"""Topic and sentiment classification."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.nested import (
    add_classifications,
    classification,
    translation_for,
    with_complement,
)
from feedlens.functions.text import clean_text
from feedlens.operators.engines import run_on_distinct_texts
from feedlens.operators.sizing import MAX_INLINE_ROWS
from feedlens.operators.tokens import class_votes, vote_terms, votes_for
from feedlens.schema import CLASSIFICATION
from feedlens.session import cut_lineage, scratch_dir

NO_CLASSIFICATIONS = "array<struct<topic:string,score:double,agent:string>>"
POSITIVE, NEGATIVE = "POSITIVE", "NEGATIVE"


def text_to_classify(lang: str | None) -> Column:
    """The original without a language; else the translation into it; else the cleaned original."""
    if lang is None:
        return F.col("text")
    found = translation_for(F.col("translations"), lang)
    return F.when(found.isNotNull(), found["text"]).otherwise(clean_text(F.col("text")))


def _append(messages: DataFrame, made: Column, text: Column) -> DataFrame:
    none = F.array().cast(NO_CLASSIFICATIONS)
    new = F.when(text.isNull(), none).otherwise(made)
    return messages.withColumn("classifications", add_classifications(F.col("classifications"), new))


def classify_sentiment(
    messages: DataFrame,
    polarity: DataFrame,
    lang: str | None = None,
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """Two entries: the winning label with its share of the polar words, and the complement.

    Without any polar word both get 0.5; the positive label wins a tie.
    """
    text = text_to_classify(lang)
    table = polarity.select("word", F.when(F.col("sign") > 0, POSITIVE).otherwise(NEGATIVE).alias("label"))
    voted = class_votes(messages, table, "label", text, max_inline=max_inline)
    good = votes_for(F.col("_votes"), POSITIVE).cast("double")
    bad = votes_for(F.col("_votes"), NEGATIVE).cast("double")
    share = F.coalesce(F.greatest(good, bad) / F.nullif(good + bad, F.lit(0.0)), F.lit(0.5))
    wins = good >= bad
    label = F.when(wins, POSITIVE).otherwise(NEGATIVE)
    other = F.when(wins, NEGATIVE).otherwise(POSITIVE)
    return _append(voted, with_complement(label, other, share), text).drop("_votes")


def classify_labels(
    messages: DataFrame,
    label_terms: DataFrame,
    labels: list[str],
    lang: str | None = None,
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """One entry per given label, in that order: the share of its terms found in the text."""
    if not labels:
        raise ValueError("class labels must be specified")
    text = text_to_classify(lang)
    table = label_terms.where(F.col("label").isin(labels)).select("label", F.lower("term").alias("word"))
    sizes = {
        row["label"]: row["n"]
        for row in vote_terms(table, "label").groupBy("label").agg(F.count("*").alias("n")).limit(len(labels)).collect()
    }
    voted = class_votes(messages, table, "label", text, distinct=True, max_inline=max_inline)
    agent = F.lit("model")
    made = F.array(
        *[
            classification(F.lit(label), votes_for(F.col("_votes"), label) / F.lit(float(sizes.get(label, 1))), agent)
            for label in labels
        ]
    )
    return _append(voted, made, text).drop("_votes")


def _cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return dot(a, b) / F.nullif(norm, F.lit(0.0))


def centroid_scores(vectors: DataFrame, labels: list[int], vector: str = "embedding", label: str = "label") -> DataFrame:
    """Add ``scores``: the cosine of each vector to the mean vector of each given label.

    The means, one short vector per given label, come from one partial
    aggregation over (label, dimension) and reach the rows as a scalar subquery.
    """
    if not labels:
        raise ValueError("class labels must be specified")
    means = (
        vectors.where(F.col(label).isin(labels))
        .select(F.col(label).alias("label"), F.posexplode(F.col(vector)).alias("d", "v"))
        .groupBy("label", "d")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
        .groupBy("label")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("d", "v"))), lambda e: e["v"]).alias("mean"))
        .agg(F.sort_array(F.collect_list(F.struct("label", "mean"))).alias("means"))
    )
    wide = vectors.withColumn("_v", F.col(vector).cast("array<double>")).withColumn("_means", means.scalar())
    scored = F.transform(
        "_means",
        lambda m: F.struct(m["label"].alias("label"), _cosine(F.col("_v"), m["mean"]).alias("score")),
    )
    return wide.withColumn("scores", scored).drop("_v", "_means")


def fit_topics(labelled: DataFrame, features: int = 1 << 14, text: str = "text", label: str = "label") -> PipelineModel:
    """A bag-of-words logistic model over ``(text, label index)`` rows, which are computed once.

    The model is written to the shared folder and loaded from there: a fresh one
    carries its training summary, and with it the session, into every task, which
    fails once anything was observed in that session.
    """
    labelled = cut_lineage(labelled.select(text, label))
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"[^\p{L}\p{N}_]+"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(
            featuresCol="_tfidf", labelCol=label, probabilityCol="_probability", rawPredictionCol="_raw",
            predictionCol="_prediction", regParam=0.01, maxIter=20,
        ),
    ]
    path = scratch_dir(labelled.sparkSession, "model")
    Pipeline(stages=stages).fit(labelled).write().save(path)
    return PipelineModel.load(path)


def classify_trained(messages: DataFrame, model: PipelineModel, labels: list[str], lang: str | None = None) -> DataFrame:
    """One entry per class in index order, with the label of that index. The model comes from ``fit_topics`` or from files."""
    text = text_to_classify(lang)
    tokenizer = model.stages[0].getInputCol()
    original = messages.columns
    prepared = messages.withColumn("_original", F.col("text")).withColumn("_input", text)
    scored = model.transform(prepared.withColumn(tokenizer, F.coalesce("_input", F.lit(""))))
    scored = scored.withColumn("_p", vector_to_array("_probability")).withColumn("text", F.col("_original"))
    made = F.transform(
        F.col("_p"), lambda p, i: classification(F.get(F.lit(labels), i), p, F.lit("model"))
    )
    return _append(scored, made, F.col("_input")).select(*[F.col(f"`{c}`") for c in original])


def classify_with_engine(messages: DataFrame, setup, labels: list[str], tries: int = 1, pause: float = 0.0) -> DataFrame:
    """Scores by a Python engine whose frame has one column per label, in order."""
    answer = T.StructType([T.StructField(f"_score_{i}", T.DoubleType()) for i in range(len(labels))])

    def prepare():
        engine = setup()
        return lambda texts: engine(texts).set_axis(answer.fieldNames(), axis=1)

    done = run_on_distinct_texts(messages, prepare, answer, tries=tries, pause=pause)
    made = F.array(
        *[classification(F.lit(label), F.col(f"_score_{i}"), F.lit("model")) for i, label in enumerate(labels)]
    ).cast(T.ArrayType(CLASSIFICATION))
    made = F.filter(made, lambda c: c["score"].isNotNull())
    return _append(done, made, F.col("text")).drop(*answer.fieldNames())
