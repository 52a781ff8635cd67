"""The SQL table without a database: its queries run by Spark, which reads this dialect's quotes, over a stand-in."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st

from feedlens.schema import MESSAGE_COLUMNS
from feedlens.sources.sqltable import SqlTable, sql_rows, time_slices
from pyspark.sql import functions as F

START = datetime(2024, 1, 1, 6)


class StandIn(SqlTable):
    """Keeps tables as views; ``asked`` holds what would have been sent."""

    def __init__(self, spark, rows):
        super().__init__(spark, "jdbc:mysql://nowhere/db", "stored")
        self.asked, self.dropped = [], []
        rows.createOrReplaceTempView("stored")

    def _load(self, source, predicates=None):
        if predicates is None:
            return self.spark.sql(f"SELECT * FROM {source}")
        self.asked += predicates
        parts = [self.spark.sql(f"SELECT * FROM {source} WHERE {p}") for p in predicates]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out

    def _save(self, rows, table):
        rows.createOrReplaceTempView(table)

    def _execute(self, statement):
        if statement.startswith("DROP TABLE "):
            self.dropped.append(statement.removeprefix("DROP TABLE "))
            return
        columns, select = statement.removeprefix("INSERT INTO stored (").split(") ", 1)
        assert columns.replace("`", "").split(", ") == MESSAGE_COLUMNS
        kept = self.spark.sql("SELECT * FROM stored").unionByName(self.spark.sql(select))
        self.spark.createDataFrame(kept.collect(), kept.schema).createOrReplaceTempView("stored")

    def ids(self):
        return sorted(r.id_ for r in self.spark.sql("SELECT id_ FROM stored").collect())


@given(
    st.dictionaries(st.integers(0, 9).map(lambda d: date(2024, 1, 1) + timedelta(days=d)), st.integers(1, 5000), max_size=8),
    st.integers(1, 2000), st.integers(0, 9 * 24 * 3600),
)
def test_slices_hold_every_moment_once(counts, rows, seconds):
    end = START + timedelta(seconds=seconds)
    slices = time_slices(START, end, counts, rows)
    assert slices[0][0] == START and slices[-1][1] is None
    assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(slices, slices[1:]))
    assert slices[-1][0] <= end


def test_a_busy_day_is_cut_and_quiet_days_share():
    day = date(2024, 1, 1)
    counts = {day: 10, day + timedelta(days=1): 10, day + timedelta(days=2): 1000}
    slices = time_slices("2024-01-01", "2024-01-10", counts, 100)
    assert slices[0] == (datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert len(slices) == 11


def messages(make, n=40):
    return make(*[{"datetime_": f"2024-01-0{1 + i % 4} 0{i % 10}:00:00", "country": "O'x" if i % 2 else "NLD",
                   "text": f"text {i}", "id_": f"{i:02}"} for i in range(n)])


def test_read_in_slices(make, spark):
    table = StandIn(spark, sql_rows(messages(make)).withColumn("ID", F.lit(1)))
    got = table.read("2024-01-01 03:00:00", "2024-01-04 05:00:00", "O'x", "Telegram", rows=4)
    wanted = messages(make).where("country = 'O\\'x' and datetime_ between '2024-01-01 03:00:00' and '2024-01-04 05:00:00'")
    assert got.schema == wanted.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    assert len(table.asked) > 2 and all("`country` = 'O''x'" in p and "`datetime_` >= '2024" in p for p in table.asked)


def test_all_four_filters_are_needed(make, spark):
    with pytest.raises(ValueError, match="country"):
        StandIn(spark, sql_rows(messages(make))).read("2024-01-01", "2024-01-02", None, "Telegram")


def test_names_and_values_follow_the_database(spark):
    table = SqlTable(spark, "jdbc:sqlserver://nowhere", "m")
    assert table._equal("O'x", "s") == ['"country" = \'O\'\'x\'', '"source" = \'s\'']


def test_insert_new_takes_over_what_is_missing(make, spark):
    table = StandIn(spark, sql_rows(messages(make, 10)))
    counts = table.insert_new(messages(make, 14), "2024-02-01 00:00:00").first()
    assert (counts.offered, counts.inserted, counts.duplicates) == (14, 4, 10)
    assert table.ids() == [f"{i:02}" for i in range(14)]
    assert len(table.dropped) == 1
    stamped = spark.sql("SELECT DISTINCT id_ FROM stored WHERE datetime_scraped_ = '2024-02-01'").collect()
    assert sorted(r.id_ for r in stamped) == ["10", "11", "12", "13"]
    again = table.insert_new(messages(make, 14), "2024-02-02 00:00:00").first()
    assert again.inserted == 0 and len(table.dropped) == 1 and len(table.ids()) == 14


def test_rows_staged_twice_are_not_taken_over(make, spark):
    table = StandIn(spark, sql_rows(messages(make, 2)))
    table._save = lambda rows, name: rows.unionAll(rows).createOrReplaceTempView(name)
    with pytest.raises(RuntimeError, match="nothing inserted"):
        table.insert_new(messages(make, 4), "2024-02-01 00:00:00")
    assert table.ids() == ["00", "01"] and len(table.dropped) == 1


def test_empty_batch(make, spark):
    table = StandIn(spark, sql_rows(messages(make, 2)))
    assert table.insert_new(messages(make, 4).where("false"), "2024-02-01 00:00:00").count() == 0
    assert table.ids() == ["00", "01"]


def test_columns_are_typed(make):
    kinds = dict(sql_rows(messages(make, 1)).dtypes)
    assert kinds["datetime_"] == kinds["datetime_scraped_"] == "timestamp_ntz" and kinds["reply"] == "boolean"
    assert kinds["info"] == kinds["translations"] == "string"
