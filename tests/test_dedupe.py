from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import compare, dedupe, topics
from feedlens.operators.numbering import number_rows


def minute(n: int) -> str:
    return f"2023-11-29 17:{n:02d}:00"


def test_first_per_id(make):
    ids = ["1", "2", "1", "3", "2"]
    rows = make(*[{"id_": v, "text": str(i), "datetime_": minute(i)} for i, v in enumerate(ids)])
    assert {r.text for r in dedupe.first_per_key(rows).collect()} == {"0", "1", "3"}


def test_first_per_id_with_wider_key(make):
    rows = make({"id_": "1", "group": "a"}, {"id_": "1", "group": "b"}, {"id_": "1", "group": "b"})
    assert dedupe.first_per_key(rows, ["source", "group", "id_"]).count() == 2


def test_first_per_text_is_case_sensitive(make):
    rows = make(*[{"text": t, "datetime_": minute(i)} for i, t in enumerate(["a", "b", "a", "A"])])
    assert {r.id_ for r in dedupe.first_per_text(rows).collect()} == {"0", "1", "3"}


def test_a_key_with_most_rows_is_reduced_before_the_exchange(spark, make):
    rows = make({}).crossJoin(spark.range(0, 3000, numPartitions=4).select(F.col("id").alias("n")))
    hot = rows.withColumn("id_", F.when(F.col("n") % 3 > 0, "hot").otherwise(F.col("n").cast("string"))).drop("n")
    once = dedupe.first_per_key(hot)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert once.count() == 1001


def store_and_batch(make):
    stored = make({"id_": "9", "text": "z"})
    batch = make({"id_": "1", "text": "k"}, {"id_": "1", "text": "k"}, {"id_": "2", "text": "m"}, {"id_": "9", "text": "z"})
    return stored, batch


def test_new_rows_keeps_one_copy(make):
    stored, batch = store_and_batch(make)
    assert sorted(r.text for r in dedupe.new_rows(batch, stored).collect()) == ["k", "m"]


def test_new_rows_matches_null_keys(make):
    stored = make({"id_": "1", "text": None})
    batch = make({"id_": "1", "text": None}, {"id_": "2", "text": None})
    assert [r.id_ for r in dedupe.new_rows(batch, stored).collect()] == ["2"]


def test_new_rows_keeps_all_columns(make):
    batch = make({"id_": "1", "lon": 1.0, "lat": 2.0, "translations": [("a", "b", "c")]})
    got = dedupe.new_rows(batch, batch.limit(0)).collect()
    assert got == batch.collect()


def test_strict_drops_both_copies(make):
    stored, batch = store_and_batch(make)
    assert [r.text for r in dedupe.new_rows_strict(batch, stored).collect()] == ["m"]


def test_strict_with_nothing_stored_checks_nothing(make):
    batch = make({"id_": "1", "text": "k"}, {"id_": "1", "text": "k"}, {"id_": "2", "text": "m"})
    assert dedupe.new_rows_strict(batch, batch.limit(0)).count() == 3
    elsewhere = make({"id_": "1", "text": "k", "country": "UKR"}, {"text": "old", "datetime_": "2020-01-01 00:00:00"})
    assert dedupe.new_rows_strict(batch, elsewhere).count() == 3


def test_insert_counts(make):
    stored, batch = store_and_batch(make)
    got = dedupe.insert_counts(batch, dedupe.new_rows(batch, stored)).first()
    assert (got.offered, got.inserted, got.duplicates) == (4, 2, 2)


def test_last_version(make):
    stored = make({"id_": "1", "text": "a"})
    incoming = make(
        {"id_": "1", "text": "b", "datetime_scraped_": minute(1)},
        {"id_": "1", "text": "c", "datetime_scraped_": minute(2)},
        {"id_": "2", "text": "d"},
    )
    got = dedupe.last_version(stored, incoming, ["country", "id_"], [F.col("datetime_scraped_").desc()])
    assert {(r.id_, r.text) for r in got.collect()} == {("1", "c"), ("2", "d")}


def test_numbers_run_over_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.when(F.col("id") % 3 < 2, "big").when(F.col("id") % 3 == 2, None).alias("g"), (-F.col("id")).alias("v")
    )
    got = number_rows(df, ["g"], [F.col("v").asc()]).collect()
    for group in ("big", None):
        rows = sorted((r.v, r.number) for r in got if r.g == group)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))
    assert len(got) == 5000


def test_numbers_joined_by_a_row_key_equal_numbers_of_whole_rows(spark):
    df = spark.range(0, 3000, numPartitions=5).select(
        "id", F.when(F.col("id") % 3 < 2, "big").otherwise(None).alias("g"), F.repeat(F.lit("x"), 50).alias("text")
    )
    order = [F.pmod(F.col("id") * 7919, F.lit(3001)).asc()]
    whole = {(r.id, r.number) for r in number_rows(df, ["g"], order).collect()}
    by_key = number_rows(df, ["g"], order, row_key=["id"])
    assert by_key.columns == ["id", "g", "text", "number"]
    assert {(r.id, r.number) for r in by_key.collect()} == whole
    # the texts are not written to number the rows
    scans = [line for line in by_key._jdf.queryExecution().optimizedPlan().toString().splitlines() if "parquet" in line]
    assert scans and not any("text" in line for line in scans)


def test_topic_vocabulary(make):
    rows = make({"classifications": [("a", 1.0, "model"), ("a", 0.5, "human")]}, {"classifications": [("b", 1.0, "model")]})
    assert {(r.topic, r.messages) for r in topics.topic_vocabulary(rows).collect()} == {("a", 1), ("b", 1)}
    assert {r.topic for r in topics.topic_vocabulary(make({}), ["x", "y"]).collect()} == {"x", "y"}
    assert {r.topic for r in topics.topic_vocabulary(rows, ["x"]).collect()} == {"a", "b"}


def test_topic_vocabulary_without_any_fails(make):
    import pytest

    with pytest.raises(Exception, match="fallback labels"):
        topics.topic_vocabulary(make({})).collect()


def test_message_diff(make):
    left = make({"text": "a"}, {"text": None}, {"text": "c"})
    right = make({"text": "a"}, {"text": "b"}, {"text": "c", "group": None}, {"text": "d"})
    got = compare.message_diff(left, right, ["id_"], ["text", "group"])
    assert {r.field: r.differing for r in got.collect()} == {
        "text": 1, "group": 1, "(left only)": 0, "(right only)": 1,
    }
