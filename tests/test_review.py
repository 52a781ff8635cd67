from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedlens.operators import review
from feedlens.sources.reviewset import read_review_set, write_review_set

ANSWERS = "workspace string, dataset string, external_id string, status string, topics array<string>, anonymization string, translation string"


def minute(n: int) -> str:
    return f"2023-11-29 17:{n:02d}:00"


@pytest.fixture
def records(make):
    rows = make(
        {"text": "a", "datetime_": minute(0), "translations": [("t", "uk", "en")],
         "classifications": [("A", 0.5, "model"), ("B", 0.9, "model")]},
        {"text": "", "datetime_": minute(1)},
        {"text": "IFRC b", "datetime_": minute(2)},
        {"text": "a", "datetime_": minute(3)},
    )
    return review.review_export(rows, ["ifrc"], "NLD-1")


def test_export_numbers_leave_a_gap_for_empty_text(records):
    got = {r.external_id: r for r in records.collect()}
    assert {k: r.metadata.number for k, r in got.items()} == {"0": 1, "2": 3}
    assert {k: r.metadata.keyword_flag for k, r in got.items()} == {"0": "No", "2": "Yes"}
    assert got["0"].workspace == "nld" and got["0"].suggestion.topic == "B" and got["2"].suggestion is None
    assert (got["0"].text_translated, got["2"].text_translated) == ("t", "")
    assert got["0"].metadata.datetime == "2023-11-29T17:00:00"


def test_copies_that_arrive_together_are_exported_once(make):
    rows = make(
        {"id_": "1", "text": "a", "source": "B"}, {"id_": "1", "text": "a", "source": "A"},
        {"id_": "1", "text": "a", "source": "A", "country": "UKR"}, {"id_": "1", "text": "b", "source": "A"},
        {"id_": "2", "text": None}, {"id_": "2", "text": "c"},
    )
    got = review.review_export(rows, ["x"], F.concat("country", F.lit("-1"))).collect()
    assert sorted((r.text_original, r.metadata.source, r.dataset) for r in got) == [
        ("a", "A", "NLD-1"), ("b", "A", "NLD-1"), ("c", "Telegram", "NLD-1"),
    ]
    # the null text has a number of its own
    assert len({r.metadata.number for r in got}) == 3 and max(r.metadata.number for r in got) <= 4


def test_import_merges_answers(spark, records):
    answers = spark.createDataFrame(
        [("nld", "NLD-1", "0", "submitted", ["A", "B"], None, "u"), ("nld", "NLD-1", "2", "discarded", ["A"], None, None)], ANSWERS
    )
    back = {r.id_: r for r in review.review_import(records, answers).collect()}
    assert [tuple(t) for t in back["0"].translations] == [("u", "uk", "en")]
    assert [tuple(c) for c in back["0"].classifications] == [("B", 0.9, "model"), ("A", 1.0, "human"), ("B", 1.0, "human")]
    assert back["2"].translations == [] and back["2"].classifications == []
    assert back["0"].info.group_members is None and back["0"].reply is False
    only = review.review_import(records, answers, only_submitted=True).collect()
    assert [r.id_ for r in only] == ["0"]


def test_import_limit_is_by_number(spark, records):
    none = spark.createDataFrame([], ANSWERS)
    assert [r.id_ for r in review.review_import(records, none, limit=1).collect()] == ["0"]


def test_agreement_and_anonymization(spark, records):
    answers = spark.createDataFrame(
        [("nld", "NLD-1", "0", "submitted", ["A", "B"], "my [name]", None), ("nld", "NLD-1", "2", "submitted", ["A"], "", None)], ANSWERS
    )
    got = {(r.suggested, r.human, r.agree): r.records for r in review.agreement(records, answers).collect()}
    assert got == {("B", "A", False): 1, ("B", "B", True): 1, (None, "A", False): 1}
    texts = {r.external_id: r.text for r in review.apply_anonymization(records, answers).collect()}
    assert texts == {"0": "my [name]", "2": "IFRC b"}


def test_review_set_replace_and_clash(spark, records, tmp_path):
    path = str(tmp_path / "sets")
    write_review_set(records, path)
    other = records.withColumn("dataset", F.lit("NLD-2"))
    write_review_set(other, path, replace=False)
    write_review_set(records.where("external_id = '0'"), path)
    assert read_review_set(spark, path, "NLD-1", "NLD").count() == 1
    assert read_review_set(spark, path, "NLD-2", "NLD").count() == 2
    with pytest.raises(ValueError, match="exists"):
        write_review_set(other, path, replace=False)
