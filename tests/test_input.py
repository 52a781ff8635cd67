"""Counts of landed records, counts by stage, large CSV files, values that are no numbers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from feedlens.operators.totals import StageTotals
from feedlens.plans.pipeline import run_listening
from feedlens.schema import info_struct
from feedlens.sources import files, gazetteer, raw
from feedlens.sources.store import MessageStore


def line(n: int, **other) -> str:
    return json.dumps({"id": n, "date": "2024-01-14T10:00:00", "message": f"a message of some length {n}", "channel": "c1", **other})


def test_account_by_file(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([line(1), line(2)[:-1], "", "no json", line(3, message=None), line(4, replies="many")]))
    (tmp_path / "b.json").write_text(line(5) + "\n")
    (tmp_path / "empty.json").write_text("")
    records = raw.read_records(spark, str(tmp_path), raw.CHANNEL_SCHEMA)
    account = raw.input_account(records, F.coalesce("record.message", F.lit("")) == "")
    got = {r.file.rsplit("/", 1)[1]: (r.records, r.good, r.malformed, r.empty) for r in account.collect()}
    # a field of another type is malformed although nobody reads it
    assert got == {"a.json": (5, 1, 3, 1), "b.json": (1, 1, 0, 0)}


def test_records_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"results": [{"_id": 1, "text": "x"}]}, indent=2))
    (tmp_path / "b.json").write_text("{\n")
    records = raw.read_records(spark, str(tmp_path), raw.FORM_SCHEMA, multi_line=True).collect()
    assert sorted(r.malformed for r in records) == [False, True]
    assert [r.record.results[0].text for r in records if not r.malformed] == ["x"]


def test_nothing_is_stored_beyond_the_stated_share(spark, tmp_path):
    (tmp_path / "landed").mkdir()
    (tmp_path / "landed" / "a.json").write_text("\n".join([line(1), line(2), line(3, message="short"), "no json"]))
    store = MessageStore(spark, str(tmp_path / "store"))

    def listen(share: float) -> dict:
        return run_listening(
            spark, "telegram", str(tmp_path / "landed"), "ukr", "2024-01-15", "2024-01-15 12:00:00", store,
            str(tmp_path / "sets"), ["x"], {"anonymize": lambda df: df}, channels=["c1"], max_malformed=share,
        )

    with pytest.raises(RuntimeError, match="1 of 4 landed records are malformed"):
        listen(0.2)
    assert store.last_commit() == 0
    made = listen(0.25)
    assert (made["landed"], made["malformed"], made["processed"]) == (4, 1, 2)
    assert made["stages"] == {"extract": 3, "filter": 2, "anonymize": 2, "processed": 2}
    assert store.all().count() == 2


def test_stage_totals_of_an_empty_table(spark):
    totals = StageTotals()
    totals.watch(totals.watch(spark.range(0), "first").where("id > 1"), "second").collect()
    assert totals.counts() == {"first": 0, "second": 0}
    with pytest.raises(ValueError, match="watched"):
        totals.watch(spark.range(1), "first")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_ranges_equals_the_reader_of_whole_files(spark, tmp_path, end):
    texts = ["plain", 'two\n"lines"', "", "\n\n", 'a,"b"\r\nc', "x" * 300, '"', "line\n" * 40, " edges "]
    for part in range(2):
        rows = ["id_,datetime_,datetime_scraped_,country,source,group,text,reply,reply_to,translations,info,classifications"]
        for i in range(150):
            text = texts[i % len(texts)].replace('"', '""')
            rows.append(f'{part * 1000 + i},2023-11-29 17:00:00,2023-11-29T17:00:00,NLD,T,g,"{text}",False,,,,')
        (tmp_path / f"{part}.csv").write_bytes((end.join(rows) + (end if part else "")).encode())
    target = tmp_path / "messages.csv"
    target.mkdir()
    for part in range(2):
        (tmp_path / f"{part}.csv").rename(target / f"{part}.csv")
    def comparable(rows) -> list:
        plain = end if end == "\r\n" else "\n"
        return sorted((r.id_, r.text.replace(plain, "\n"), r.group, r.datetime_) for r in rows)

    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(str(target)).rdd.getNumPartitions() > 20
        for legacy in (False, True):
            whole = files.read_csv(spark, str(tmp_path), legacy, in_ranges=False).select("id_", "text", "group", "datetime_").collect()
            ranged = files.read_csv(spark, str(tmp_path), legacy, in_ranges=True).select("id_", "text", "group", "datetime_").collect()
            assert len(ranged) == 300 and comparable(ranged) == comparable(whole)
            # in ranges a text keeps its own line breaks, where the other reader takes those of the file for plain ones
            assert {r.text for r in ranged} == set(texts)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_values_that_are_no_numbers_are_absent(spark):
    rows = spark.createDataFrame([(1.0, float("nan")), (1.0, 2.0), (None, 1.0)], "lon double, lat double")
    got = [r.i.coordinates for r in rows.select(info_struct(lon=F.col("lon"), lat=F.col("lat")).alias("i")).collect()]
    assert got[0] is None and tuple(got[1]) == (1.0, 2.0) and got[2] is None


def test_ids_of_places_have_64_bits(spark, tmp_path):
    feature = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}}
    rows = [json.dumps({**feature, "properties": {"name": f"place {i}"}}) for i in range(200)]
    (tmp_path / "places.json").write_text("\n".join(rows))
    ids = [r.loc_id for r in gazetteer.read_features(spark, str(tmp_path), ["name"]).collect()]
    assert len(set(ids)) == 200 and max(map(abs, ids)) > 2**40
