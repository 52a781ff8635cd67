"""Parts of a store that hold many days: their number stays bounded, reads and upserts find their rows."""

from __future__ import annotations

from feedlens.sources import store as store_module
from feedlens.sources.store import MessageStore, _parts_of

DAYS = [f"20{y}-{m:02d}-{d:02d}" for y in (22, 23) for m in range(1, 13) for d in (1, 11, 28)]


def test_parts_do_not_grow_with_the_days(spark, make, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "MAX_PARTS", 6, raising=False)
    monkeypatch.setattr(store_module, "CROWDED", 3)
    store = MessageStore(spark, str(tmp_path / "store"))
    rows = [{"id_": f"{c}{i}", "country": c, "datetime_": f"{day} 10:00:00"} for c in ("NLD", None) for i, day in enumerate(DAYS)]
    odd = [{"id_": "old", "datetime_": "0001-01-02 10:00:00"}, {"id_": "far", "datetime_": "9999-12-30 10:00:00"},
           {"id_": "none", "datetime_": None}, {"id_": None, "datetime_": f"{DAYS[5]} 10:00:00"}]
    store.append(make(*rows, *odd))
    parts = lambda: _parts_of(store.log.read()[1])
    assert len(parts()) <= 12 and store.verify() == []
    assert store.all().count() == len(rows) + len(odd)

    def ids(start=None, end=None):
        return {r.id_ for r in store.read(start, end, "NLD").collect()}

    assert ids(f"{DAYS[5]} 00:00:00", f"{DAYS[7]} 23:00:00") == {"NLD5", "NLD6", "NLD7", None}
    assert ids(f"{DAYS[9]} 10:00:01", f"{DAYS[10]} 09:59:59") == set()
    assert ids(start=f"{DAYS[70]} 10:00:00") == {"NLD70", "NLD71", "far"} and ids(end="0001-02-01 00:00:00") == {"old"}

    def upsert(n, **row):
        store.upsert(make({"country": "NLD", "datetime_scraped_": f"2024-01-{n:02d} 00:00:00", **row}))

    # a message moves from one span to another; neighbours of days never named stay, and can be found later
    upsert(1, id_="NLD3", datetime_=f"{DAYS[60]} 12:00:00", text="moved")
    upsert(2, id_="NLD4", datetime_=f"{DAYS[4]} 10:00:00", text="new")
    upsert(3, id_="none", datetime_=f"{DAYS[2]} 10:00:00", text="dated")
    for n in range(4, 9):  # appends crowd one span
        store.append(make({"id_": f"more{n}", "datetime_": f"{DAYS[8]} 1{n}:00:00"}))
    upsert(9, id_="more5", datetime_=f"{DAYS[9]} 10:00:00", text="again")
    assert len(parts()) <= 18 and store.verify() == []
    got = {r.id_: (str(r.datetime_)[:10], r.text) for r in store.read(country="NLD").where("id_ is not null").collect()}
    want = {f"NLD{i}": (day, "text") for i, day in enumerate(DAYS)} | {f"more{n}": (DAYS[8], "text") for n in range(4, 9)}
    want |= {"old": ("0001-01-02", "text"), "far": ("9999-12-30", "text"), "none": (DAYS[2], "dated")}
    assert got == want | {"NLD3": (DAYS[60], "moved"), "NLD4": (DAYS[4], "new"), "more5": (DAYS[9], "again")}
    assert store.all().count() == len(rows) + len(odd) + 5
    store.compact()
    assert store.all().count() == len(rows) + len(odd) + 5 and store.verify() == [] and len(parts()) <= 12
    upsert(10, id_="NLD3", datetime_=f"{DAYS[0]} 12:00:00", text="back")
    assert ids(f"{DAYS[0]} 00:00:00", f"{DAYS[0]} 23:00:00") == {"NLD0", "NLD3"} and "NLD3" not in ids(f"{DAYS[60]} 00:00:00", f"{DAYS[61]} 00:00:00")
