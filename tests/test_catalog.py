"""Every query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from check_oracles import TABLES, _rows

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMOKE_DIR}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_oracle(spark, duck, name):
    got = queries()[name](spark, SMOKE_DIR)
    rows = got.collect()
    if name not in oracle_sql():
        assert rows
        return
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert _rows(got.columns, rows) == _rows(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_no_plan_compares_all_pairs(spark):
    for name in ("scan_search_queries", "geo_text_match_blocked", "geo_point_in_region_grid", "keyword_flag_joined"):
        plan = queries()[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
