"""Messages in a table of a SQL database, read in slices of time and written by way of a staging table.

Every slice is one query with all filters in its WHERE clause, so the database
sends only what is asked for, over as many connections as there are slices. Slices
are cut by the rows that the database counts for each day: quiet days share one, a
busy day is cut into equal pieces. Rows of one second are never cut apart; drivers
hand them over in blocks of ``FETCH`` rows, whatever their number.

An insert compares the batch with what is stored in its own windows of time, by
the key columns alone, and writes what is new to a staging table. One statement
takes the rows over from there. So a lost task or a failed job leaves the table as
it was; repeated, it inserts what is still missing. Two writers of the same
country and source at the same time are not guarded against each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.codec import NESTED, decode_nested
from feedlens.operators.dedupe import STORED_KEY, batch_bounds, insert_counts, new_rows, new_rows_strict
from feedlens.operators.filters import require_not_null, required_range
from feedlens.operators.sizing import rows_if_small
from feedlens.schema import MESSAGE_COLUMNS, to_messages
from feedlens.session import cut_lineage

ROWS_PER_SLICE = 1_000_000
FETCH = 10_000
MAX_WINDOWS = 300  # of (country, source) pairs in a batch that are named in queries


def _moment(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def time_slices(
    start: datetime | str, end: datetime | str, counts: dict[date, int], rows: int = ROWS_PER_SLICE
) -> list[tuple[datetime, datetime | None]]:
    """``(from, before)`` pairs that cover ``start`` to ``end``; the last has no ``before``: it holds ``end``.

    ``counts`` are the rows of each day. A slice gets at most ``rows`` of them, if
    a day's rows are spread evenly over it.
    """
    start, end = _moment(start), _moment(end)
    cuts, held = [], 0
    for day, n in sorted(counts.items()):
        midnight = datetime.combine(day, time())
        first, last = max(start, midnight), min(end, midnight + timedelta(days=1))
        if held + n > rows:
            cuts.append(first)
            held = 0
        pieces = -(-n // rows)
        cuts += [(first + (last - first) * i / pieces).replace(microsecond=0) for i in range(1, pieces)]
        held += -(-n // max(pieces, 1))
    bounds = [start, *sorted({c for c in cuts if start < c <= end})]
    return list(zip(bounds, [*bounds[1:], None]))


class SqlTable:
    """Read with the four filters, or insert only what is new.

    ``options`` are those of Spark's JDBC source, user and password included.
    Nested parts are JSON text in the table, datetimes are of its timestamp type.
    """

    def __init__(self, spark: SparkSession, url: str, table: str, **options: str):
        self.spark = spark
        self.url = url
        self.table = table
        self.options = {"fetchsize": str(FETCH), "preferTimestampNTZ": "true", **options}
        self._dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)

    # --- what reaches the database -----------------------------------------------

    def _load(self, source: str, predicates: list[str] | None = None) -> DataFrame:
        """A table or bracketed query; one connection for each predicate."""
        return self.spark.read.jdbc(self.url, source, predicates=predicates, properties=self.options)

    def _save(self, rows: DataFrame, table: str) -> None:
        rows.write.jdbc(self.url, table, mode="errorifexists", properties=self.options)

    def _execute(self, statement: str) -> None:
        jvm = self.spark._jvm
        if "driver" in self.options:
            jvm.java.lang.Class.forName(self.options["driver"])
        properties = jvm.java.util.Properties()
        for name, value in self.options.items():
            properties.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    # --- queries -----------------------------------------------------------------

    def _name(self, column: str) -> str:
        return self._dialect.quoteIdentifier(column)

    def _value(self, value: datetime | str) -> str:
        """A literal; datetimes as text, which databases take for either type."""
        text = value.isoformat(" ") if isinstance(value, datetime) else value
        return self._dialect.compileValue(text)

    def _equal(self, country: str, source: str) -> list[str]:
        return [f"{self._name('country')} = {self._value(country)}", f"{self._name('source')} = {self._value(source)}"]

    def predicates(self, start, end, wanted: list[str], rows: int = ROWS_PER_SLICE) -> list[str]:
        """One WHERE clause for each slice of the time from ``start`` to ``end``, both included."""
        at = self._name("datetime_")
        start, end = _moment(start), _moment(end)
        whole = " AND ".join([*wanted, f"{at} >= {self._value(start)}", f"{at} <= {self._value(end)}"])
        day, count = self._name("day_"), self._name("rows_")
        counted = self._load(
            f"(SELECT CAST({at} AS DATE) AS {day}, COUNT(*) AS {count} FROM {self.table} "
            f"WHERE {whole} GROUP BY CAST({at} AS DATE)) counted"
        )
        days = {r[0]: int(r[1]) for r in counted.select(F.col("day_").cast("date"), "rows_").collect()}
        made = []
        for first, before in time_slices(start, end, days, rows):
            until = f"{at} <= {self._value(end)}" if before is None else f"{at} < {self._value(before)}"
            made.append(" AND ".join([*wanted, f"{at} >= {self._value(first)}", until]))
        return made

    def read(self, start, end, country: str, source: str, rows: int = ROWS_PER_SLICE) -> DataFrame:
        """Messages of one country and source from ``start`` to ``end``; all four must be given.

        The identity column is not read.
        """
        for name, value in {"start": start, "end": end, "country": country, "source": source}.items():
            if value is None:
                raise ValueError(f"please specify {name} to query the message table")
        stored = self._load(self.table, self.predicates(start, end, self._equal(country, source), rows))
        kept = stored.select(*[F.col(f"`{c}`") for c in stored.columns if c in MESSAGE_COLUMNS])
        # the same filters once more, by Spark's rules: a database may compare texts without regard to case
        return required_range(to_messages(decode_nested(kept)), start, end, country, source)

    def _beside(self, incoming: DataFrame) -> DataFrame | None:
        """Key columns of what is stored in the windows of a batch; None where the batch is empty."""
        bounds = batch_bounds(incoming)
        windows = rows_if_small(bounds, MAX_WINDOWS)
        if windows is None:
            ends = bounds.agg(F.min("min_datetime"), F.max("max_datetime")).first()
            wanted = self.predicates(*ends, [])
        else:
            wanted = [p for w in windows for p in self.predicates(
                w["min_datetime"], w["max_datetime"], self._equal(w["country"], w["source"]))]
        if not wanted:
            return None
        stored = self._load(self.table, wanted)
        kinds = dict(incoming.dtypes)
        return stored.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in self._compared()])

    @staticmethod
    def _compared() -> Iterable[str]:
        return dict.fromkeys([*STORED_KEY, "country", "source", "datetime_"])

    def insert_new(self, incoming: DataFrame, scraped_at: datetime | str, strict: bool = False) -> DataFrame:
        """Insert the rows that are not stored yet, stamped with the time of scraping.

        Returns what happened: ``source, offered, inserted, duplicates``.
        """
        incoming = cut_lineage(require_not_null(incoming))
        stored = self._beside(incoming)
        if stored is None:
            return insert_counts(incoming, incoming)
        fresh = cut_lineage((new_rows_strict if strict else new_rows)(incoming, stored))
        n = fresh.count()
        if n:
            self._take_over(sql_rows(fresh.withColumn("datetime_scraped_", F.lit(str(scraped_at)).cast("timestamp_ntz"))), n)
        return insert_counts(incoming, fresh)

    def _take_over(self, rows: DataFrame, n: int) -> None:
        staged = f"{self.table}_stage_{uuid.uuid4().hex[:12]}"
        self._save(rows, staged)
        try:
            there = self._load(f"(SELECT COUNT(*) AS {self._name('rows_')} FROM {staged}) counted").first()[0]
            if there != n:  # a task that was run again after its rows had been committed
                raise RuntimeError(f"{there} rows staged where {n} are new: nothing inserted")
            columns = ", ".join(map(self._name, MESSAGE_COLUMNS))
            self._execute(f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {staged}")
        finally:
            self._execute(f"DROP TABLE {staged}")


def sql_rows(messages: DataFrame) -> DataFrame:
    """Messages as columns of a SQL table: nested parts as JSON text, all others typed."""
    return messages.select(*[
        F.to_json(F.col(c)).alias(c) if c in NESTED else F.col(f"`{c}`") for c in MESSAGE_COLUMNS
    ])
