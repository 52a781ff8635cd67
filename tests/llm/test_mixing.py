from __future__ import annotations

from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedlens.llm import mixing


def test_assignment_equals_sql(edge_docs):
    documents = edge_docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    db = duckdb.connect()
    db.register("documents", documents)
    want = db.execute(mixing.ORACLE_SQL).fetchdf()
    got = mixing.assign(edge_docs).select(*want.columns).toPandas()
    order = ["doc_id", "size", "source_size", "target", "taken"]
    got, want = (x[order].astype(float).sort_values(order, ignore_index=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want)


def test_targets_are_met_and_bounded(edge_docs):
    got = mixing.assign(edge_docs).toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg(
        taken=("taken", "sum"), size=("size", "sum"), target=("target", "first"), rows=("size", "size"))
    assert ((per["target"] - per["taken"]).abs() < 1 + per["rows"]).all()
    assert (per["target"] <= 2 * per["size"] + 1e-9).all()
    assert per["target"].sum() == pytest.approx(1.5 * per["size"].sum())
    placed = got["position"].dropna()
    assert placed.is_monotonic_increasing and placed.between(0, 1).all()


def test_reruns_agree(edge_docs):
    once, again = (mixing.assign(edge_docs.repartition(n)).toPandas() for n in (2, 5))
    key = ["doc_id", "source", "size", "taken"]
    pd.testing.assert_frame_equal(once.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True))


def test_training_time_inverts_the_integral(spark):
    rows = [(w, f / 50) for w in ([1.0, 3.0], [1.5, 1.0, 0.5], [0.0, 2.0, 2.0, 0.0, 1.0]) for f in range(50)]
    df = spark.createDataFrame(rows, "weights array<double>, fraction double")
    df = df.withColumn("integrals", mixing._integrals(F.col("weights")))
    for row in df.withColumn("t", mixing.training_time(F.col("fraction"), F.col("weights"), F.col("integrals"))).collect():
        w, steps = row["weights"], len(row["weights"]) - 1
        area = 0.0
        for i in range(steps):
            x = min(max(row["t"] * steps - i, 0.0), 1.0)
            area += (w[i] * x + (w[i + 1] - w[i]) * x * x / 2) / steps
        assert area == pytest.approx(row["fraction"] * row["integrals"][-1], abs=1e-12)


def test_schedule_moves_a_source(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"),
                                   F.when(F.col("id") % 2 == 0, "early").otherwise("late").alias("source"))
    schedule = spark.createDataFrame([("early", [2.0, 0.0]), ("late", [0.0, 2.0])], "source string, weights array<double>")
    got = mixing.assign(docs, schedule, share=1.0).toPandas()
    mean = got.groupby("source")["position"].mean()
    assert mean["early"] == pytest.approx(1 / 3, abs=0.05) and mean["late"] == pytest.approx(2 / 3, abs=0.05)


def test_mixed_documents_are_whole(edge_docs, edge_rows):
    got = mixing.mix(edge_docs)
    assert got.columns == edge_docs.columns
    have, there = Counter((r["doc_id"], r["text"]) for r in got.collect()), Counter((r[0], r[1]) for r in edge_rows)
    assert set(have) <= set(there) and all(n <= 2 * there[k] for k, n in have.items())
    taken = mixing.assign(edge_docs).agg(F.sum("taken")).first()[0]
    words = got.agg(F.sum(mixing.size_of(F.col("text")))).first()[0]
    assert abs(words - taken) <= 0.5 * edge_docs.agg(F.sum(mixing.size_of(F.col("text")))).first()[0]


def test_empty(no_docs):
    assert mixing.assign(no_docs).collect() == []
    assert mixing.mix(no_docs).collect() == []
