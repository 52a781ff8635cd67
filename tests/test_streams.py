"""State of streams: outside the heap, once per id, and over a restart in the middle."""

from __future__ import annotations

import os

from feedlens.session import SESSION_CONF
from feedlens.streaming import streams

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def test_dedupe_over_a_restart_in_the_middle(spark, make, tmp_path):
    assert spark.conf.get(PROVIDER) == SESSION_CONF[PROVIDER]
    landed, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    schema = make({}).schema
    parts = [[{"id_": "1"}] * 50 + [{"id_": "2"}], [{"id_": "2"}, {"id_": "3"}, {"id_": None}], [{"id_": "3"}] * 20 + [{"id_": "4"}, {"id_": None}]]

    def run() -> int:
        rows = streams.stream_files(spark, landed, schema, "parquet", max_files=1)
        query = streams.write_stream(streams.dedupe_stream(rows), out, progress)
        query.awaitTermination()
        found = [p for p in query.recentProgress if p.stateOperators]
        assert all(len(p.stateOperators) == 1 for p in found)  # one pass of state
        return max((p.stateOperators[0].numRowsTotal for p in found), default=0)

    for n, part in enumerate(parts, 1):  # a new query each time, from the checkpoint of the one before
        make(*part).repartition(1).write.mode("append").parquet(landed)
        rows_in_state = run()
        ids = {r["id_"] for p in parts[:n] for r in p}
        assert rows_in_state == len(ids)  # the distinct ids of the window
        assert sorted(str(r.id_) for r in spark.read.parquet(out).collect()) == sorted(map(str, ids))
    logs = [f for _, _, files in os.walk(f"{progress}/state") for f in files]
    assert any(f.endswith(".changelog") for f in logs)


def test_copies_are_dropped_where_they_are_read(spark, make, monkeypatch):
    rows = make(*[{"id_": str(i % 3)} for i in range(60)]).repartition(2)
    assert streams.first_of_task(rows, ["id_"]).count() <= 6
    monkeypatch.setattr(streams, "HELD_KEYS", 1)  # forgetting lets copies pass, never drops an id
    assert {r.id_ for r in streams.first_of_task(rows, ["id_"]).collect()} == {"0", "1", "2"}
