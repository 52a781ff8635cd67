"""The commit log, the index of ids, and the store on them."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from feedlens.sources import store as store_module
from feedlens.sources.commitlog import CommitLog
from feedlens.sources.store import MessageStore, _parts_of, _runs_of


def texts(store):
    return sorted((r.id_, r.text) for r in store.all().collect())


def commit_file(store, number, kind="commit"):
    return f"{store.path}/log/{number:020d}.{kind}"


@pytest.mark.parametrize("left", ["empty", "torn", "folder", "folder with a file"])
def test_a_commit_that_is_none_loses_nothing(spark, make, tmp_path, left):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": "1", "text": "a"}))
    store.append(make({"id_": "2", "text": "b"}))
    place = commit_file(store, 3)
    if left.startswith("folder"):
        os.makedirs(place)
        if left != "folder":
            open(f"{place}/part-0", "w").close()
    else:
        whole = open(commit_file(store, 2), "rb").read()
        open(place, "wb").write(b"" if left == "empty" else whole[: len(whole) // 2])
    assert texts(store) == [("1", "a"), ("2", "b")]
    for write in (lambda: store.append(make({"id_": "3"})), lambda: store.upsert(make({"id_": "1"})), store.compact):
        with pytest.raises(RuntimeError, match="cannot be read"):
            write()
    assert texts(store) == [("1", "a"), ("2", "b")]
    assert store.discard_unreadable() == [3]
    store.append(make({"id_": "3", "text": "c"}))
    assert texts(store) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_competing_writers(spark, make, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store, other = MessageStore(spark, path), MessageStore(spark, path)
    store.append(make({"id_": "1", "text": "a"}))
    write = MessageStore._write

    def overtaken(self, rows, *more):
        out = write(self, rows, *more)
        if self is store:
            other.append(make({"id_": "9", "text": "other"}))
        return out

    monkeypatch.setattr(MessageStore, "_write", overtaken)
    with pytest.raises(RuntimeError, match="somebody else"):
        store.upsert(make({"id_": "1", "text": "b"}))
    assert texts(store) == [("1", "a"), ("9", "other")]
    store.append(make({"id_": "2", "text": "c"}))  # an append goes behind the other one
    assert texts(store) == [("1", "a"), ("2", "c"), ("9", "other"), ("9", "other")]


def test_a_log_of_a_thousand_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    for n in range(1000):  # as many as upserts may follow each other
        assert log.add(n, {f"key/{n % 7}": n}, [f"key/{(n + 3) % 7}"]) == n + 1
    opened = []
    load = log._load
    log._load = lambda number, kind: opened.append((number, kind)) or load(number, kind)
    number, state = log.read()
    assert number == 1000 and len(state) <= 7 and len(opened) <= log.every
    # a snapshot that is torn is passed over
    open(f"{log.path}/{1000:020d}.snapshot", "wb").write(b"{")
    assert log.read() == (1000, state)
    with pytest.raises(RuntimeError, match="somebody else"):
        log.add(999, {}, [])


def test_many_upserts_keep_the_state_constant(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "RUNS", 4)
    monkeypatch.setattr(store_module, "CROWDED", 4)
    store = MessageStore(spark, str(tmp_path / "store"))
    sizes, plans = [], []
    for i in range(14):
        if i % 2:
            store.append(make({"id_": f"new{i}", "text": "n"}))
        else:
            store.upsert(make({"id_": str(i % 3), "text": f"v{i}", "datetime_scraped_": f"2024-01-{i + 1:02d} 00:00:00"}))
        _, state = store.log.read()
        sizes.append((len(_parts_of(state)), len(_runs_of(state))))
        plans.append(len(store.all()._jdf.queryExecution().analyzed().toString()))
    assert max(parts for parts, _ in sizes) <= 5 and max(runs for _, runs in sizes) <= 8
    assert max(plans[7:]) <= 1.1 * max(plans[:7])
    assert texts(store) == sorted([("0", "v12"), ("1", "v10"), ("2", "v8")] + [(f"new{i}", "n") for i in range(1, 14, 2)])
    assert store.verify() == []


def test_an_upsert_reads_the_buckets_of_its_ids_and_the_days_they_are_in(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "BUCKET_IDS", 8)
    read = []

    def grown(days):
        store = MessageStore(spark, str(tmp_path / f"store{days}"))
        store.append(make(*({"id_": f"{d}-{i}", "datetime_": f"2023-11-{d:02d} 10:00:00"} for d in range(1, days + 1) for i in range(8))))
        opened = []
        live, index = MessageStore._live, MessageStore._index
        monkeypatch.setattr(MessageStore, "_live", lambda self, parts: opened.append(live(self, parts)) or opened[-1])
        monkeypatch.setattr(MessageStore, "_index", lambda self, *a: opened.append(index(self, *a)) or opened[-1])
        store.upsert(make({"id_": "1-1", "datetime_": "2023-11-02 09:00:00", "text": "moved"}))
        monkeypatch.undo()
        monkeypatch.setattr(store_module, "BUCKET_IDS", 8)
        files = {f for df in opened for f in df.inputFiles()}
        read.append(sum(os.path.getsize(f.removeprefix("file://")) for f in files if f"store{days}/" in f))
        assert store.all().where("text = 'moved'").count() == 1 and store.all().count() == 8 * days

    grown(4)
    grown(24)
    assert read[1] <= 1.3 * read[0]


def test_the_index_follows_a_message_that_moves(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "RUNS", 3)
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": "1", "datetime_": "2023-11-01 10:00:00"}, {"id_": "1", "datetime_": "2023-11-02 10:00:00"}))
    ids = spark.createDataFrame([("NLD", "1"), ("NLD", None), ("NLD", "x")], "country string, id_ string")
    days = lambda: sorted(str(r["day"]) for r in store._days_of(ids, _runs_of(store.log.read()[1])).distinct().collect())
    assert days() == ["2023-11-01", "2023-11-02"]
    for day in range(3, 10):
        store.upsert(make({"id_": "1", "datetime_": f"2023-11-{day:02d} 10:00:00", "datetime_scraped_": f"2024-01-{day:02d} 00:00:00"}))
        assert days() == [f"2023-11-{day:02d}"] and store.all().count() == 1
    store.append(make({"id_": "1", "datetime_": "2023-11-20 10:00:00"}))
    assert days() == ["2023-11-09", "2023-11-20"]


def test_messages_without_id_are_kept_one_by_one(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": None, "text": "a"}, {"id_": None, "text": "b"}, {"id_": "1", "text": "c"}))
    for _ in range(2):
        store.upsert(make({"id_": "1", "text": "d"}, {"id_": "2", "text": "e"}))
    assert sorted(r.text for r in store.all().collect()) == ["a", "b", "d", "e"]
    with pytest.raises(Exception, match="specify id_"):
        store.upsert(make({"id_": None}))


def test_odd_countries(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    countries = ["NL/D;x", "a=b", "c d%", "é:'", None]
    store.append(make(*({"id_": str(i), "country": c} for i, c in enumerate(countries))))
    assert {(r.id_, r.country) for r in store.all().collect()} == {(str(i), c) for i, c in enumerate(countries)}
    assert store.verify() == []
    for i, c in enumerate(countries[:4]):
        assert [r.id_ for r in store.read(country=c).collect()] == [str(i)]
        store.upsert(make({"id_": str(i), "country": c, "text": "new", "datetime_": "2024-01-01 10:00:00"}))
    assert sorted((r.id_, r.text) for r in store.all().collect()) == [*((str(i), "new") for i in range(4)), ("4", "text")]


def test_lost_files_are_noticed(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({"id_": "1"}, {"id_": "2"}))
    folder = f"{store.path}/data/{_parts_of(store.log.read()[1])[0].folder}"
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    assert len(store.verify()) == 1
    with pytest.raises(RuntimeError, match="lost"):
        store.upsert(make({"id_": "1", "text": "new"}))


def test_a_batch_of_a_stream_counts_once(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.upsert(make({"id_": "1", "text": "a"}), batch=("s", 4))
    for late in (4, 3):
        store.upsert(make({"id_": "1", "text": "z", "datetime_scraped_": "2030-01-01 00:00:00"}), batch=("s", late))
    assert texts(store) == [("1", "a")]
    store.upsert(make({"id_": "1", "text": "b"}), batch=("t", 0))
    store.upsert(make({"id_": "1", "text": "c"}), batch=("s", 5))
    assert texts(store) == [("1", "c")]


def test_nothing_written(spark, make, tmp_path):
    store = MessageStore(spark, str(tmp_path / "store"))
    store.append(make({}).where(F.lit(False)))
    store.upsert(make({}).where(F.lit(False)))
    store.compact()
    assert store.all().count() == 0 and store.verify() == []


def test_a_scan_of_one_row_group_is_dealt_out(spark, tmp_path, monkeypatch):
    from feedlens import session

    path = str(tmp_path / "one")
    spark.range(20_000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("text")).coalesce(1).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600k")  # several splits, of which one has all rows
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() > 1
        per_task = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        cores = spark.sparkContext.defaultParallelism
        dealt = per_task(session.spread(scan))
        if scan.rdd.getNumPartitions() < 2 * cores:
            assert len(dealt) == cores and max(dealt) < 2 * 20_000 / cores
        monkeypatch.setattr(session, "SPREAD_BYTES", 1)
        assert session.spread(scan) is scan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
