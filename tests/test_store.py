from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from feedlens.functions.codec import message_json
from feedlens.plans.pipeline import Pipeline, run_listening
from feedlens.sources import files, gazetteer, raw
from feedlens.sources.labels import read_labels
from feedlens.sources.store import MessageStore
from feedlens.streaming import streams

AT = "2023-12-01 00:00:00"


def test_csv_round_trip_keeps_text_exactly(spark, make, tmp_path):
    texts = ['plain', 'with "quotes", commas', 'two\nlines', ' edges ', 'back\\slash', 'при"віт\r\nx', '', None]
    rows = make(*[{"text": t, "translations": [("t\n\"", "uk", "en")]} for t in texts])
    path = files.write_csv(rows, str(tmp_path))
    assert path.endswith("/messages.csv")
    back = {r.id_: r for r in files.read_csv(spark, str(tmp_path)).collect()}
    assert [back[str(i)].text for i in range(len(texts))] == texts
    assert tuple(back["0"].translations[0]) == ("t\n\"", "uk", "en")
    assert back["0"].datetime_ == rows.first().datetime_


def test_csv_legacy_literals(spark, tmp_path):
    path = tmp_path / "old.csv"
    path.write_text(
        "id_,datetime_,datetime_scraped_,country,source,group,text,reply,reply_to,translations,info,classifications\n"
        "0,2023-11-29 17:00:00,2023-11-29T17:00:00,NLD,Telegram,test,hi,False,,"
        "\"[{'text': 'it\\'s', 'from_lang': 'uk', 'to_lang': 'en'}]\",\"{'test': 'random', 'group_members': 5}\","
        "\"[{'topic': 'a', 'score': 0.5, 'agent': None}]\"\n"
        "1,2023-11-29 17:00:00,2023-11-29T17:00:00,NLD,Telegram,test,hi,True,7,,,\n"
    )
    got = {r.id_: r for r in files.read_csv(spark, str(path), legacy=True).collect()}
    assert tuple(got["0"].translations[0]) == ("it's", "uk", "en")
    assert got["0"].info.extra == {"test": "random"} and got["0"].info.group_members == 5
    assert tuple(got["0"].classifications[0]) == ("a", 0.5, None)
    assert got["1"].translations == [] and got["1"].reply is True and got["1"].reply_to == "7"


def test_missing_mandatory_field(spark):
    from feedlens.schema import to_messages

    with pytest.raises(ValueError, match="datetime_"):
        to_messages(spark.createDataFrame([("1",)], "id_ string"))


def test_message_json(make):
    row = json.loads(make({"text": "é\n"}).select(message_json()).first()[0])
    assert row["id"] == "0" and row["datetime_"] == "2023-11-29T17:00:00" and row["text"] == "é\n"
    assert row["reply_to"] is None and row["translations"] == []


def test_store_insert_upsert_and_filters(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0
    first = make({"id_": "1", "text": "a"}, {"id_": "1", "text": "a"}, {"id_": "3", "text": "u", "country": "UKR"})
    store.insert_new(first, AT)
    store.insert_new(first, AT)
    assert store.all().count() == 2
    assert {str(r.datetime_scraped_) for r in store.all().collect()} == {AT}
    update = make(
        {"id_": "1", "text": "b", "datetime_scraped_": "2023-12-02 00:00:00"},
        {"id_": "1", "text": "c", "datetime_scraped_": "2023-12-03 00:00:00"},
        {"id_": "2", "text": "d"},
    )
    for _ in range(2):
        store.upsert(update)
        assert {(r.id_, r.text) for r in store.all().collect()} == {("1", "c"), ("2", "d"), ("3", "u")}
    assert [r.id_ for r in store.read(country="UKR").collect()] == ["3"]
    plan = store.read(country="UKR", start=AT)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan and "GreaterThanOrEqual(datetime_" in plan
    with pytest.raises(ValueError, match="source"):
        store.read_required(AT, AT, "NLD", None)


def test_store_strict_insert_and_guard(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": "9", "text": "z"}))
    store.insert_new(make({"id_": "1"}, {"id_": "1"}, {"id_": "2"}, {"id_": "9", "text": "z"}), AT, strict=True)
    assert sorted(r.id_ for r in store.all().collect()) == ["2", "9"]
    with pytest.raises(Exception, match="specify source"):
        store.insert_new(make({"source": None}), AT)


def channel_export(tmp_path, rows):
    path = tmp_path / "raw.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def raw_row(id_, message, day=10, channel="c1", parent=None, **more):
    row = {"id": id_, "date": f"2024-01-{day:02d}T10:00:00", "message": message, "channel": channel,
           "post": True, "replies": 0, "broadcast": True, **more}
    return row if parent is None else {**row, "reply_to": {"reply_to_msg_id": parent}, "post": False}


def test_read_channels(spark, tmp_path):
    path = channel_export(tmp_path, [
        raw_row(1, "first", replies=2), raw_row(1, "copy", day=11), raw_row(2, "old", day=1), raw_row(3, ""),
        raw_row(4, "other", channel="c9"), raw_row(5, "answer", parent=1), raw_row(6, "stray", parent=99),
        raw_row(7, None),
    ])
    members = spark.createDataFrame([("c1", 42)], "channel string, members bigint")
    got = raw.read_messages(
        spark, "telegram", path, "2024-01-02", "ukr", AT, channels=["c1", "absent"], members=members, with_replies=True
    ).collect()
    assert {(r.id_, r.text, r.reply, r.reply_to) for r in got} == {
        ("1", "first", False, None), ("5", "answer", True, "1"),
    }
    assert {(r.country, r.info.group_members) for r in got} == {("UKR", 42)}
    until = raw.read_messages(spark, "telegram", path, "2024-01-01", "ukr", AT, "2024-01-02", channels=["c1"])
    assert [r.text for r in until.collect()] == ["old"]
    with pytest.raises(ValueError, match="not supported"):
        raw.read_messages(spark, "fax", path, "2024-01-01", "ukr", AT)


def test_replies_of_a_hot_post_are_all_kept(spark):
    posts = [(1, "2024-01-10 10:00:00", "p", "c", None, True, 500, True)]
    replies = [(i, "2024-01-10 10:00:00", "r", "c", (1,), False, 0, True) for i in range(2, 502)]
    schema = "id bigint, date string, message string, channel string, reply_to struct<reply_to_msg_id:bigint>, post boolean, replies bigint, broadcast boolean"
    from feedlens.operators.threads import posts_with_replies

    rows = spark.createDataFrame(posts + replies, schema)
    split = F.col("reply_to").isNotNull()
    assert posts_with_replies(rows.where(~split), rows.where(split)).count() == 501


def test_read_posts_and_forms(spark, tmp_path):
    path = tmp_path / "posts.json"
    rows = [
        {"id": 1, "user": "u1", "text": "Water NEEDED", "is_reshare": False, "created_at": "2024-01-10T10:00:00"},
        {"id": 2, "user": "u1", "text": "again", "is_reshare": True, "created_at": "2024-01-10T10:00:00"},
        {"id": 3, "user": "u2", "text": "no water", "created_at": "2024-01-10T10:00:00"},
        {"id": 4, "user": "u3", "text": "else", "created_at": "2024-01-10T10:00:00"},
    ]
    path.write_text("\n".join(json.dumps(r) for r in rows))
    queries = spark.createDataFrame([(" Water ",), ("needed",)], "query string")
    got = raw.read_messages(spark, "twitter", str(path), "2024-01-01", "NLD", AT, users=["u1"], queries=queries)
    assert sorted(r.id_ for r in got.collect()) == ["1", "3"]

    form = tmp_path / "form.json"
    record = {"_id": 7, "_submission_time": "2024-01-10T10:00:00", "text": "t", "group": "g"}
    form.write_text(json.dumps({"count": 2, "results": [record, {**record, "_id": 8}]}, indent=1))
    got = raw.read_messages(spark, "kobo", str(form), "2024-01-01", "NLD", AT, asset="a1").collect()
    assert {(r.id_, r.source, r.info.extra["kobo_asset"]) for r in got} == {("7", "Kobo", "a1"), ("8", "Kobo", "a1")}


def test_gazetteer_features(spark, tmp_path):
    path = tmp_path / "places.json"
    features = [
        {"type": "Feature", "properties": {"name": "Kyiv"}, "geometry": {"type": "Point", "coordinates": [30.5, 50.4]}},
        {"type": "Feature", "properties": {"name": "Box"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 2], [0, 2], [0, 0]]]}},
    ]
    path.write_text("\n".join(json.dumps(f) for f in features))
    got = gazetteer.read_features(spark, str(path), ["name", "absent"])
    assert got.columns == ["loc_id", "name", "lon", "lat", "rings"]
    rows = {r["name"]: r for r in got.collect()}
    assert (rows["kyiv"].lon, rows["kyiv"].lat, rows["kyiv"].rings) == (30.5, 50.4, None)
    assert (round(rows["box"].lon, 6), round(rows["box"].lat, 6), len(rows["box"].rings[0])) == (2.0, 1.0, 4)


def test_feature_collections_with_holes_and_parts(spark, make, tmp_path):
    from feedlens.operators import geo

    def square(x, y, size, clockwise=False):
        ring = [[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]
        return ring[::-1] if clockwise else ring

    shapes = [
        ("Ring", "Anillo", {"type": "Polygon", "coordinates": [square(0, 0, 10, True), square(4, 4, 2)]}),
        ("Isles", None, {"type": "MultiPolygon", "coordinates": [[square(20, 0, 1)], [square(30, 0, 1), square(30.25, 0.25, 0.5)]]}),
        ("Dot", "Punto", {"type": "Point", "coordinates": [5, 5]}),
        ("Line", None, {"type": "LineString", "coordinates": [[0, 0], [9, 9]]}),
    ]
    collection = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": n, "name_es": e}, "geometry": g} for n, e, g in shapes]}
    points = [(1.0, 1.0), (5.0, 5.0), (20.5, 0.5), (30.5, 0.5), (30.1, 0.1), (25.0, 0.5)]
    messages = make(*({"id_": str(i), "lon": x, "lat": y} for i, (x, y) in enumerate(points)))
    want = {("0", 0, "ring"), ("0", 1, "anillo"), ("2", 0, "isles"), ("4", 0, "isles")}
    for name, indent in (("one.json", None), ("many.json", 1)):
        (tmp_path / name).write_text(json.dumps(collection, indent=indent))
        places = gazetteer.read_features(spark, str(tmp_path / name), ["name", "name_es"], multi_line=indent is not None)
        middle = {r["name"]: (r.lon, r.lat) for r in places.collect()}
        assert middle["ring"] == pytest.approx((5.0, 5.0)) and middle["dot"] == (5.0, 5.0) and middle["line"] == (None, None)
        assert middle["isles"] == pytest.approx(((20.5 * 1 + 30.5 * 0.75) / 1.75, 0.5))
        for forced in (False, True):
            got = geo.match_regions(messages, places, force_grid=forced, fields=["name", "name_es"]).collect()
            assert {(r.id_, r.field_ix, r.name) for r in got} == want and len(got) == len(want)
    named = geo.match_place_names(make({"text": "the isles"}), places, ["name"]).collect()
    assert [r.name for r in named] == ["isles"]


def test_read_labels(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text(json.dumps({str(i): f"topic {i}" for i in reversed(range(29))}, indent=1))
    assert read_labels(spark, str(path)) == [f"topic {i}" for i in range(29)]
    path.write_text('{"0": "a", "2": "b"}')
    with pytest.raises(ValueError, match="indexes"):
        read_labels(spark, str(path))


def test_stream_dedupe_over_batches_and_replay(spark, make, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = make({}).schema
    for part in ([{"id_": "1"}, {"id_": "2"}], [{"id_": "2"}, {"id_": "3"}]):
        make(*part).coalesce(1).write.mode("append").parquet(landed)
    for _ in range(2):
        rows = streams.stream_files(spark, landed, schema, "parquet", max_files=1)
        streams.write_stream(streams.dedupe_stream(rows), out, str(tmp_path / "progress")).awaitTermination()
        assert sorted(r.id_ for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_stream_upsert_equals_batch(spark, make, tmp_path):
    landed = str(tmp_path / "in")
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": "1", "text": "a"}))
    schema = make({}).schema
    for day, text in (("2023-12-02", "b"), ("2023-12-03", "c")):
        make({"id_": "1", "text": text, "datetime_scraped_": f"{day} 00:00:00"}, {"id_": "2", "text": "d"}).coalesce(1).write.mode("append").parquet(landed)
        rows = streams.stream_files(spark, landed, schema, "parquet", max_files=1)
        streams.upsert_stream(rows, store, str(tmp_path / "progress")).awaitTermination()
    assert {(r.id_, r.text) for r in store.all().collect()} == {("1", "c"), ("2", "d")}


def test_end_to_end(spark, tmp_path):
    path = channel_export(tmp_path, [
        raw_row(1, "a text that is long enough"), raw_row(2, "short"), raw_row(3, "a text that is long enough"),
    ])
    store = MessageStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        made = run_listening(
            spark, "telegram", path, "ukr", "2024-01-15", "2024-01-15 12:00:00", store, str(tmp_path / "sets"),
            ["ifrc"], {"anonymize": lambda df: df}, channels=["c1"],
        )
    assert made["dataset"] == "UKR-2024-01-01-2024-01-15" and made["processed"] == 2
    assert sorted(r.id_ for r in store.all().collect()) == ["1", "3"]
    assert [r.external_id for r in spark.read.parquet(str(tmp_path / "sets")).collect()] == ["1"]

    pipe = Pipeline(store, stages={"anonymize": lambda df: df.withColumn("text", F.lit("x"))})
    pipe.run(extract=False, country="UKR")
    assert {r.text for r in store.all().collect()} == {"x"}


def test_upsert_survives_a_stop_between_any_two_steps(spark, make, tmp_path, monkeypatch):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make(*({"id_": str(i), "country": c, "text": "old"} for i, c in enumerate(["NLD", "NLD", "UKR", "BBB"]))))
    update = make({"id_": "1", "text": "new", "datetime_scraped_": "2023-12-02 00:00:00"}, {"id_": "7", "text": "new"})
    before = {(r.id_, r.text) for r in store.all().collect()}
    for step in ("_write", "_commit"):
        def stop(*_):
            raise OSError("stopped")

        with monkeypatch.context() as m:
            m.setattr(MessageStore, step, stop)
            with pytest.raises(OSError):
                store.upsert(update)
        assert {(r.id_, r.text) for r in store.all().collect()} == before
    for _ in range(2):
        store.upsert(update)
        want = {("0", "old"), ("1", "new"), ("2", "old"), ("3", "old"), ("7", "new")}
        assert {(r.id_, r.text) for r in store.all().collect()} == want
    store.compact()
    assert {(r.id_, r.text) for r in store.all().collect()} == want


def test_upsert_touches_only_the_parts_of_its_messages(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make(*({"id_": str(d), "datetime_": f"2023-11-{d:02d} 10:00:00"} for d in range(1, 11))))
    # message 3 moves to another day: its old part is rewritten, too
    store.upsert(make({"id_": "3", "datetime_": "2023-11-05 09:00:00", "text": "moved"}))
    parts = store._parts(store.last_commit())
    fresh = {str(day) for version, _, day, live in parts if live and version != parts[0][0]}
    assert {str(day) for _, _, day, live in parts if not live} == {"2023-11-03", "2023-11-05"} and fresh == {"2023-11-05"}
    assert sorted(int(r.id_) for r in store.all().collect()) == list(range(1, 11))
    assert [r.text for r in store.read(start="2023-11-05 09:00:00", end="2023-11-05 09:00:00").collect()] == ["moved"]


def test_second_writer_fails(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": "1"}))
    with pytest.raises(RuntimeError, match="somebody else"):
        store._commit(0, [("v", "NLD", None, True)])
    assert store.all().count() == 1


def test_insert_returns_its_counts(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    rows = make({"id_": "1", "text": "a"}, {"id_": "1", "text": "a"}, {"id_": "2", "text": "b"})
    assert [tuple(r) for r in store.insert_new(rows, AT).collect()] == [("Telegram", 3, 2, 1)]
    assert [tuple(r) for r in store.insert_new(rows, AT).collect()] == [("Telegram", 3, 0, 3)]
