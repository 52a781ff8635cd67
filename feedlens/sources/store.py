"""The message store: versioned Parquet files by country and day, an index of ids, and a log of commits.

Every write puts its files into a version directory of its own and then adds a
commit, which names the (country, day) parts that it brings, with their row
counts, and those that they replace. Readers follow the newest commit and scan the
directories of its live parts, chosen by country and day before Spark lists them;
nothing that a commit names is ever overwritten. So a write that stops at any point
leaves the store as it was, and running it again completes it; what it left behind
is never read.

A part holds one day of a country; where that would make more than about
``MAX_PARTS`` parts of a write, it holds as many days as keeps to that number, so
the folders, the log and the listing of a version do not grow with the days.

The index tells in which days an id is stored. Each write adds a run of
(country, id, day) rows, cut by hash into buckets of about ``BUCKET_IDS`` ids, so
an upsert reads the buckets of its own ids, whatever the store holds (beyond
``MAX_BUCKETS`` buckets a run's buckets grow). Runs of like size are merged when
there are ``RUNS`` of them, and a day whose rows lie in more than ``CROWDED``
versions is rewritten: the state of the store, its plan and the work of one upsert
do not grow with the number of writes before it.

Appends of several writers succeed each other. An upsert or compaction fails if
another write was committed since it began; repeated, it succeeds.
"""

from __future__ import annotations

import logging
import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators.dedupe import batch_bounds, insert_counts, last_version, new_rows, new_rows_strict
from feedlens.operators.filters import optional_range, require_not_null, required_range
from feedlens.operators.sizing import rows_if_small
from feedlens.schema import MESSAGE_COLUMNS, MESSAGE_SCHEMA
from feedlens.session import cut_lineage, job_scratch
from feedlens.sources.commitlog import CommitLog

log = logging.getLogger(__name__)

_EPOCH = date(1970, 1, 1).toordinal()

MAX_BOUNDS = 300
MAX_PARTS = 1000  # that a write aims at; days are put together until there are no more
SPANS = [4**i for i in range(10)]  # days to a part: 1 if that makes few parts; each divides the next
BUCKET_IDS = 1 << 16
MAX_BUCKETS = 4096
MAX_NAMED_BUCKETS = 1000  # of one upsert; beyond, whole runs are read
RUNS = 8
CROWDED = 16
APPEND_TRIES = 10
STORED_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField("version", T.StringType()),
                              T.StructField("day", T.DateType())])
INDEX_SCHEMA = "country string, id_ string, day date, seq long, sole boolean, run string, bucket int"


def balanced(messages: DataFrame) -> DataFrame:
    """Rows gathered by country and day into files of even size, in order of time.

    Without it every task would leave a file in every partition. Adaptive execution
    splits a partition with much data and merges small ones; the order lets a time
    filter skip row groups.
    """
    gathered = messages.hint("rebalance", F.col("country"), F.col("day"))
    return gathered.sortWithinPartitions("country", "day", "datetime_")


def _first_day(span: int) -> Column:
    """The first day of the part that a row's ``day`` falls into; spans are counted from 1970."""
    day = F.unix_date("day")
    first = F.date_from_unix_date(day - F.pmod(day, F.lit(span)))
    return F.col("day") if span == 1 else F.when(first.isNotNull(), F.greatest(first, F.lit("0001-01-01").cast("date")))


def _block(day: date, span: int) -> int:
    """Which span of days, counted from 1970, a day falls into."""
    return (day.toordinal() - _EPOCH) // span


def _with_day(messages: DataFrame) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in MESSAGE_COLUMNS]
    return messages.select(*columns, F.col("datetime_").cast("date").alias("day"))


def _folder_value(name: str) -> str | None:
    """The value in a partition folder's name."""
    value = name.split("=", 1)[1]
    if value == "__HIVE_DEFAULT_PARTITION__":
        return None
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


class Part:
    """The rows of one country and day, or span of days from that day on, in one version."""

    def __init__(self, key: str, value: list):
        self.key = key
        self.folder = key.removeprefix("part/")
        self.version = self.folder.split("/")[0].removeprefix("version=")
        self.country: str | None = value[0]
        self.day: date | None = date.fromisoformat(value[1]) if value[1] else None
        self.rows: int = value[2]
        self.beside: int = value[3]  # parts that its version was written with
        self.span: int = value[4] if len(value) > 4 else 1

    @property
    def last(self) -> date:
        """The last day that its rows can have."""
        after = (_block(self.day, self.span) + 1) * self.span + _EPOCH
        return date.fromordinal(min(after - 1, date.max.toordinal()))

    def at(self, span: int) -> tuple:
        """Its country, and the span of so many days that it lies in."""
        return self.country, None if self.day is None else _block(self.day, span)


def _parts_of(state: dict) -> list[Part]:
    return [Part(k, v) for k, v in state.items() if k.startswith("part/")]


def _crowded(parts: list[Part]) -> list[Part]:
    """The parts that hold days which lie in more than ``CROWDED`` versions; spans lie within each other or apart."""
    spans = sorted({p.span for p in parts})
    own = Counter((p.span, *p.at(p.span)) for p in parts)
    full = set()
    for p in {(p.span, *p.at(p.span)): p for p in parts}.values():
        over = [(s, *p.at(s)) for s in spans if s >= p.span]
        if sum(own[key] for key in over) > CROWDED:
            full.update(over)
    return [p for p in parts if (p.span, *p.at(p.span)) in full]


def _runs_of(state: dict) -> dict[str, dict]:
    return {k.removeprefix("run/"): v for k, v in state.items() if k.startswith("run/")}


def _side_by_side(first: Callable[[], dict], second: Callable[[], dict]) -> dict:
    """What two jobs, run at the same time, put into a commit."""
    with ThreadPoolExecutor(1) as pool:
        other = pool.submit(second)
        return first() | other.result()


def _counted(seen: Observation) -> int:
    """The rows that were observed; a plan that turns out empty while it runs leaves no count."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return 0


class MessageStore:
    """Read with filters, insert only what is new, or upsert by id.

    A message is identified by country and id. Messages stored without an id are
    kept one by one; an upsert refuses them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    # --- commits ---------------------------------------------------------------

    def last_commit(self) -> int:
        """The number of the newest commit, 0 before the first."""
        return self.log.read()[0]

    def _parts(self, commit: int) -> list[tuple]:
        """(version, country, day, live): what the newest commit leaves live, and what ``commit`` replaced."""
        _, state = self.log.read()
        change = self.log.changes(commit)
        replaced = []
        for key in change["drop"]:
            if key.startswith("part/"):
                version, country, day = (_folder_value(x) for x in key.removeprefix("part/").split("/"))
                replaced.append((version, country, date.fromisoformat(day) if day else None, False))
        return [(p.version, p.country, p.day, True) for p in _parts_of(state)] + replaced

    def _commit(self, base: int, put: dict, drop: list[str] | None = None) -> int:
        """Changes the store, if ``base`` is still its newest commit."""
        return self.log.add(base, put, drop or [])

    def _names(self, path: str) -> list[str]:
        """The folders in a folder."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # as one string: a call per folder would take longer than the listing
        listed = self.spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(files.listStatus(at))
        return sorted(re.findall(r"/([^/]+=[^/]*?); isDirectory=true", listed))

    @staticmethod
    def _span(rows: DataFrame, least: int = 1) -> int:
        """How many days a part of these rows gets: as few as make about ``MAX_PARTS`` parts of them."""
        spans = [s for s in SPANS if s >= least]
        parts = [F.approx_count_distinct(F.xxhash64("country", _first_day(s))).alias(str(s)) for s in spans]
        made = rows.select("country", "day").agg(*parts).first()
        return next((s for s in spans if made[str(s)] <= MAX_PARTS), spans[-1])

    def _write(self, rows: DataFrame, span: int, indexed: Callable[[str], dict] | None = None) -> dict:
        """Writes rows with their day as a new version of parts of ``span`` days; the parts for the commit.

        ``indexed`` gets the version's path and brings more for the commit, while
        the rows of the parts are counted.
        """
        version = f"version={uuid.uuid4().hex}"
        path = f"{self.path}/data/{version}"
        balanced(rows.withColumn("day", _first_day(span))).write.partitionBy("country", "day").parquet(path)

        def counted() -> dict:
            made = self.spark.read.schema(STORED_SCHEMA).option("basePath", f"{self.path}/data").parquet(path)
            rows_of = {(r["country"], r["day"]): r["count"] for r in made.groupBy("country", "day").count().collect()}
            found = [(c, d) for c in self._names(path) for d in self._names(f"{path}/{c}")]
            put = {}
            for country, day in found:
                named, on = _folder_value(country), _folder_value(day)
                n = rows_of.get((named, date.fromisoformat(on) if on else None), 0)
                put[f"part/{version}/{country}/{day}"] = [named, on, n, len(found), span]
            return put

        return counted() if indexed is None else _side_by_side(counted, lambda: indexed(path))

    def _live(self, parts: list[Part]) -> DataFrame:
        """All rows of the parts, with version and first day of the part; a version that is whole is opened by its own folder."""
        if not parts:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        by_version = defaultdict(list)
        for p in parts:
            by_version[p.version].append(p)
        folders = []
        for version, mine in by_version.items():
            folders += [f"version={version}"] if len(mine) == mine[0].beside else [p.folder for p in mine]
        paths = [f"{self.path}/data/{folder}" for folder in folders]
        return self.spark.read.schema(STORED_SCHEMA).option("basePath", f"{self.path}/data").parquet(*paths)

    def discard_unreadable(self) -> list[int]:
        """Removes commits that stopped half-way; only for when no writer is at work."""
        return self.log.discard_unreadable()

    def verify(self) -> list[str]:
        """The folders of live parts that do not hold as many rows as was committed."""
        parts = _parts_of(self.log.read()[1])
        counted = self._live(parts).groupBy("version", "country", "day").count().collect()
        found = {(r["version"], r["country"], r["day"]): r["count"] for r in counted}
        return [p.folder for p in parts if found.get((p.version, p.country, p.day), 0) != p.rows]

    # --- the index of ids ----------------------------------------------------------

    def _write_run(self, entries: DataFrame, rows: int, seq: int) -> dict:
        """Writes index rows ``country, id_, day, seq, sole`` as a run; its entry for the commit."""
        buckets = min(MAX_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, rows) / BUCKET_IDS))))
        run = uuid.uuid4().hex
        path = f"{self.path}/index/run={run}"
        spot = F.pmod(F.xxhash64("country", "id_"), F.lit(buckets)).cast("int")
        gathered = entries.withColumn("bucket", spot).repartition("bucket").dropDuplicates()
        gathered.sortWithinPartitions("bucket", "country", "id_").write.partitionBy("bucket").parquet(path)
        filled = sorted(int(_folder_value(name)) for name in self._names(path))
        return {f"run/{run}": {"rows": rows, "buckets": buckets, "filled": filled, "seq": seq}}

    def _index(self, runs: dict[str, dict], wanted: set[int] | None = None) -> DataFrame:
        """The rows of some runs; of the buckets that hold a hash in ``wanted`` (modulo ``MAX_BUCKETS``) if given."""
        paths = []
        for run, about in runs.items():
            asked = None if wanted is None else {h % about["buckets"] for h in wanted}
            paths += [f"{self.path}/index/run={run}/bucket={b}" for b in about["filled"] if asked is None or b in asked]
        if not paths:
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        return self.spark.read.schema(INDEX_SCHEMA).option("basePath", f"{self.path}/index").parquet(*paths)

    @staticmethod
    def _standing(entries: DataFrame) -> DataFrame:
        """Index rows without those that a later upsert of their id has overtaken."""
        last = F.max(F.when(F.col("sole"), F.col("seq"))).over(Window.partitionBy("country", "id_"))
        return entries.withColumn("_last", last).where(F.col("_last").isNull() | (F.col("seq") >= F.col("_last"))).drop("_last")

    def _days_of(self, ids: DataFrame, runs: dict[str, dict]) -> DataFrame:
        """``country, day`` where rows with these ids (``country, id_``) are stored."""
        wanted = None
        if any(about["buckets"] > 1 for about in runs.values()):
            spot = F.pmod(F.xxhash64("country", "id_"), F.lit(MAX_BUCKETS)).cast("int").alias("spot")
            named = rows_if_small(ids.select(spot).distinct(), MAX_NAMED_BUCKETS)
            wanted = None if named is None else {r["spot"] for r in named}
        entries = self._index(runs, wanted).drop("run", "bucket")
        mine = entries.join(ids.select("country", "id_").distinct(), ["country", "id_"], "left_semi")
        return self._standing(mine).select("country", "day")

    # --- reading ---------------------------------------------------------------

    def _chosen(self, state: dict, start=None, end=None, country: str | None = None) -> list[Part]:
        """The live parts that can hold rows of a country and a stretch of time."""
        first, last = (None if x is None else str(x)[:10] for x in (start, end))
        parts = [p for p in _parts_of(state) if country is None or p.country == country]
        timed = [
            p for p in parts
            if (first is None or (p.day is not None and p.last.isoformat() >= first))
            and (last is None or (p.day is not None and p.day.isoformat() <= last))
        ]
        return timed or parts[:1]  # where no day fits, the filters find that in one part

    def _messages(self, parts: list[Part]) -> DataFrame:
        return self._live(parts).select(*[F.col(f"`{c}`") for c in MESSAGE_COLUMNS])

    def all(self) -> DataFrame:
        """Everything stored; an empty frame while nothing is."""
        return self._messages(_parts_of(self.log.read()[1]))

    def read(
        self,
        start: datetime | str | None = None,
        end: datetime | str | None = None,
        country: str | None = None,
        source: str | None = None,
    ) -> DataFrame:
        """Any subset of the filters; country and day choose the folders, the rest skips row groups."""
        parts = self._chosen(self.log.read()[1], start, end, country)
        return optional_range(self._messages(parts), start, end, country, source)

    def read_required(self, start, end, country, source) -> DataFrame:
        """As ``read``, all four filters being mandatory."""
        parts = self._chosen(self.log.read()[1], start, end, country)
        return required_range(self._messages(parts), start, end, country, source)

    # --- writing ---------------------------------------------------------------

    def append(self, messages: DataFrame) -> None:
        """Adds rows as they are. Another writer's commit is no obstacle: the rows go behind it."""
        base, _ = self.log.read_to_write()
        seen = Observation(f"append-{uuid.uuid4().hex}")

        def indexed(path: str) -> dict:
            added = self.spark.read.schema(STORED_SCHEMA).option("basePath", f"{self.path}/data").parquet(path)
            entries = added.where(F.col("id_").isNotNull()).select(
                "country", "id_", F.col("datetime_").cast("date").alias("day"),
                F.lit(base + 1).cast("long").alias("seq"), F.lit(False).alias("sole"))
            return self._write_run(entries, _counted(seen), base + 1)

        rows = _with_day(messages)
        put = self._write(rows.observe(seen, F.count(F.lit(1)).alias("rows")), self._span(rows), indexed)
        if not any(key.startswith("part/") for key in put):
            return
        for tried in range(APPEND_TRIES):
            try:
                self._commit(base, put)
                break
            except RuntimeError:
                base, _ = self.log.read_to_write()
                if tried == APPEND_TRIES - 1:
                    raise
        self._tidy()

    def _beside(self, incoming: DataFrame) -> DataFrame:
        """The stored rows that can equal an incoming one.

        The bounds of the batch are computed first: they choose the folders, and
        reach the scan as constants that skip row groups.
        """
        _, state = self.log.read()
        bounds = rows_if_small(batch_bounds(incoming), MAX_BOUNDS)
        if bounds is None:  # one wide time window for all countries and sources
            ends = incoming.agg(F.min("datetime_").alias("min"), F.max("datetime_").alias("max")).first()
            return self._messages(self._chosen(state, ends["min"], ends["max"])).where(F.col("datetime_").between(
                F.lit(ends["min"]).cast("timestamp_ntz"), F.lit(ends["max"]).cast("timestamp_ntz")
            ))
        wanted: Column = F.lit(False)
        chosen: dict[str, Part] = {}
        for b in bounds:
            found = self._chosen(state, b["min_datetime"], b["max_datetime"])
            chosen |= {p.key: p for p in found if p.country == b["country"]}
            wanted = wanted | (
                F.col("country").eqNullSafe(F.lit(b["country"]))
                & F.col("source").eqNullSafe(F.lit(b["source"]))
                & F.col("datetime_").between(
                    F.lit(b["min_datetime"]).cast("timestamp_ntz"), F.lit(b["max_datetime"]).cast("timestamp_ntz")
                )
            )
        return self._messages(list(chosen.values())).where(wanted)

    def insert_new(self, incoming: DataFrame, scraped_at: datetime | str, strict: bool = False) -> DataFrame:
        """Append the rows that are not stored yet, stamped with the time of scraping.

        Returns what happened: ``source, offered, inserted, duplicates``. The batch
        is computed once, whatever engines stand behind it.
        """
        incoming = cut_lineage(require_not_null(incoming))
        select = new_rows_strict if strict else new_rows
        fresh = cut_lineage(select(incoming, self._beside(incoming)))
        self.append(fresh.withColumn("datetime_scraped_", F.lit(str(scraped_at)).cast("timestamp_ntz")))
        return insert_counts(incoming, fresh)

    def _rows_checked(self, parts: list[Part]) -> tuple[DataFrame, Observation]:
        """The rows of parts that are about to be replaced, counted as they are read."""
        seen = Observation(f"read-{uuid.uuid4().hex}")
        found = self._live(parts).observe(seen, F.count(F.lit(1)).alias("rows"))
        return found.withColumn("day", F.col("datetime_").cast("date")).drop("version"), seen

    @staticmethod
    def _refuse_lost_rows(parts: list[Part], seen: Observation) -> None:
        committed = sum(p.rows for p in parts)
        if parts and _counted(seen) < committed:  # more are seen where a lost task ran again
            raise RuntimeError(f"{_counted(seen)} rows read where {committed} are committed: files of the store are lost")

    def upsert(self, incoming: DataFrame, version: list[Column] | None = None, batch: tuple[str, int] | None = None) -> None:
        """The last version of each message wins over the stored one.

        Only the (country, day) parts that the batch falls into, or that hold an
        older version of one of its messages by the index, are read whole and
        written anew. ``batch`` names a stream and its batch: one that is already
        in the store is passed over.
        """
        version = version or [F.col("datetime_scraped_").desc_nulls_last(), F.col("datetime_").desc_nulls_last()]
        base, state = self.log.read_to_write()
        stream = None if batch is None else f"stream/{batch[0]}"
        if stream is not None and state.get(stream, -1) >= batch[1]:
            return
        with job_scratch(self.spark):
            self._merge(incoming, version, stream, batch, base, state)
        self._tidy()

    def _merge(
        self, incoming: DataFrame, version: list[Column], stream: str | None, batch: tuple[str, int] | None, base: int, state: dict
    ) -> None:
        incoming = cut_lineage(_with_day(require_not_null(incoming, ["country", "id_"])))
        offered = incoming.groupBy("country", "day").count()
        stored_days = self._days_of(incoming.select("country", "id_"), _runs_of(state)).distinct()
        days = offered.unionByName(stored_days.withColumn("count", F.lit(0).cast("long"))).collect()
        parts = _parts_of(state)
        touched = {  # parts, not messages
            (s, r["country"], None if r["day"] is None else _block(r["day"], s)) for r in days for s in {p.span for p in parts}
        }
        old = [p for p in parts if (p.span, *p.at(p.span)) in touched]
        stored, seen = self._rows_checked(old)
        with_id = last_version(stored.where(F.col("id_").isNotNull()), incoming, ["country", "id_"], version)
        entries = incoming.select("country", "id_", "day", F.lit(base + 1).cast("long").alias("seq"), F.lit(True).alias("sole"))
        # whoever replaces parts of many days makes no smaller ones of them, or their number would grow again
        span = self._span(incoming, max((p.span for p in old), default=1))
        put = _side_by_side(
            lambda: self._write(with_id.unionByName(stored.where(F.col("id_").isNull())), span),
            lambda: self._write_run(entries, sum(r["count"] for r in days), base + 1) if days else {},
        )
        self._refuse_lost_rows(old, seen)
        if stream is not None:
            put[stream] = batch[1]
        self._commit(base, put, [p.key for p in old])

    def _rewrite(self, base: int, parts: list[Part], least: int = 1) -> None:
        rows, seen = self._rows_checked(parts)
        put = self._write(rows, self._span(self._live(parts).withColumn("day", F.col("datetime_").cast("date")), least))
        self._refuse_lost_rows(parts, seen)
        self._commit(base, put, [p.key for p in parts])

    def compact(self) -> None:
        """Rewrites all live parts as one version; older versions stay for readers that hold them."""
        base, state = self.log.read_to_write()
        self._rewrite(base, _parts_of(state))

    def _tidy(self) -> None:
        """Merges runs of like size and the versions of crowded days; another writer may do it instead."""
        try:
            base, state = self.log.read_to_write()
            by_size = defaultdict(dict)
            for run, about in _runs_of(state).items():
                by_size[int(math.log(about["rows"] + 1, RUNS))][run] = about
            for runs in by_size.values():
                if len(runs) >= RUNS:
                    entries = self._standing(self._index(runs).drop("run", "bucket"))
                    made = self._write_run(entries, sum(a["rows"] for a in runs.values()), max(a["seq"] for a in runs.values()))
                    base = self._commit(base, made, [f"run/{run}" for run in runs])
            crowded = _crowded(_parts_of(state))
            if crowded:
                self._rewrite(base, crowded, max(p.span for p in crowded))
        except RuntimeError as error:
            log.info("left as it is: %s", error)
