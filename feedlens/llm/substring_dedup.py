"""Removal of passages that occur earlier in the corpus, by FM-indexes of shards.

A window is ``window`` consecutive words of one document. A word goes if a window
that covers it also starts earlier: in a document of smaller id, or earlier in
the same one. Windows are judged on the input.

A shard must hold all occurrences of a window. Every window has an anchor: of the
``anchor`` word sequences inside it that with the least hash, the leftmost of
equals. Equal windows have equal anchors, so shards are made of anchors, and
neighbouring windows mostly share one: a run of windows with one anchor is one
unit of text. Only windows that may be repeated become units: a two-plane Bloom
filter (``bloom``) over anchors, then one over the windows of repeated anchors,
leaves out the others without moving any text. Where a filter's bound is too
small for the corpus it only lets more windows through.

Of equal units within a task the earliest is sent on and the others are repeats
at once, so a passage that fills the corpus sends one unit per task. Each shard
builds an FM-index of its units and streams them through it: the matching
statistics of a position tell the window's interval of suffixes, and the first of
them is its earliest occurrence. Repeated intervals are gathered per document and
applied to its text.

Words are compared by 48 bits of XXH3, 20 at a time.

Rows, one by one: a null text has no words; texts shorter than a window keep all;
texts are read whole; rows that share id and text are equally old and do not
remove each other; rows that share only the id count as one document in the
order; a null id is smaller than any other; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import bloom
from feedlens.llm.common import batches, map_batches, utf8
from feedlens.llm.fm_index import FMIndex
from feedlens.session import cut_lineage

WINDOW = 20
ANCHOR = 8
_BASE = 0x9E3779B97F4A7C15
_WORD_BYTES = 6


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _rolled(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    out = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASE) + words[j: j + len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(29)


def windows(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the anchor of every window of a document."""
    hashes = _rolled(words, anchor)
    n = max(len(words) - window + 1, 0)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    width, best = 1, hashes  # least of ``width`` neighbours, doubled while it fits
    span = window - anchor + 1
    while 2 * width <= span:
        best, width = np.minimum(best[: len(best) - width], best[width:]), 2 * width
    best = np.minimum(best[:n], best[span - width: span - width + n])
    at = np.zeros(n, np.int64)
    for j in range(span - 1, -1, -1):  # the leftmost is set last
        np.copyto(at, j, where=hashes[j: j + n] == best)
    return best, at + np.arange(n)


def _known(plane: np.ndarray, best: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each window's anchor is in the filter; neighbours with one anchor are looked up once."""
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return np.repeat(bloom.contains(plane, best[first]), np.diff(np.append(first, len(at))))


class _Batch:
    """The words of a batch of texts in one array, and the windows that lie within one text."""

    def __init__(self, texts: list[bytes], window: int, anchor: int):
        found = [text.split() for text in texts]
        lengths = np.array([len(f) for f in found], np.int64)
        self.words = word_hashes([word for f in found for word in f])
        self.ends = np.cumsum(lengths)
        best, at = windows(self.words, window, anchor)
        end = np.repeat(self.ends, lengths)[: len(best)]
        self.start = np.flatnonzero(np.arange(len(best)) + window <= end)
        self.best, self.at = best[self.start], at[self.start]
        self.window = window

    def anchors(self) -> np.ndarray:
        """The hash of every place that is an anchor."""
        return self.best[np.flatnonzero(np.diff(self.at, prepend=-1))]

    def anchored(self, plane: np.ndarray) -> np.ndarray:
        """Whether each window's anchor is in the filter; neighbours with one anchor are looked up once."""
        if not len(self.at):
            return np.zeros(0, bool)
        first = np.flatnonzero(np.diff(self.at, prepend=-1))
        return np.repeat(bloom.contains(plane, self.best[first]), np.diff(np.append(first, len(self.at))))

    def hashes(self, which: np.ndarray) -> np.ndarray:
        """The hashes of the chosen windows."""
        return _rolled(self.words, self.window)[self.start[which]]


def _repeated_anchors(rows: DataFrame, window: int, anchor: int, max_bytes: int) -> np.ndarray:
    n_words = rows.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = bloom.plane_bits(n_words // 40, max_bytes)  # about one anchor in seven words
    return bloom.repeated_plane(
        rows.select("text"), lambda batch: _Batch(utf8(batch, "text"), window, anchor).anchors(), bits
    )


def _repeated_windows(rows: DataFrame, window: int, anchor: int, anchors) -> np.ndarray:
    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        held = _Batch(utf8(batch, "text"), window, anchor)
        return held.hashes(held.anchored(anchors.value))

    return bloom.repeated_plane(rows.select("text"), hashes, anchors.value.size * 8)


def _runs(flags: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last of each run of set flags with one value of ``at``."""
    edges = np.flatnonzero(flags[1:] & flags[:-1] & (at[1:] == at[:-1]))
    joined = np.zeros(len(flags), bool)
    joined[edges + 1] = True
    starts = np.flatnonzero(flags & ~joined)
    order = np.flatnonzero(flags)
    ends = order[np.append(np.searchsorted(order, starts[1:]) - 1, len(order) - 1)] if len(starts) else starts
    return zip(starts.tolist(), ends.tolist())


_UNIT = "text_hash long, anchor long, start long, n_windows long, content binary"


def _units(rows: DataFrame, window: int, anchor: int, planes) -> DataFrame:
    """Runs of possibly repeated windows: with their words if the earliest of their like in the task, else without."""

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, repeated = planes.value
        seen: dict[bytes, tuple] = {}
        out: list[tuple] = []
        for batch in stream:
            docs, keys = (batch.column(c).to_pylist() for c in ("doc", "text_hash"))
            held = _Batch(utf8(batch, "text"), window, anchor)
            maybe = held.anchored(anchors)
            maybe[maybe] = bloom.contains(repeated, held.hashes(maybe))
            packed = np.ascontiguousarray(held.words.view(np.uint8).reshape(-1, 8)[:, :_WORD_BYTES]).tobytes()
            hashes, begins = held.best.view(np.int64), [0, *held.ends.tolist()]
            for first, last in _runs(maybe, held.at):
                at, to = held.start.item(first), held.start.item(last) + window
                i = bisect.bisect_right(begins, at) - 1
                doc, start = docs[i], at - begins[i]
                content = packed[at * _WORD_BYTES: to * _WORD_BYTES]
                unit = (doc, keys[i], hashes.item(first), start, last - first + 1)
                like = seen.get(content)
                if like is None:
                    seen[content] = (*unit, content)
                elif (like[0], like[3]) == (doc, start):  # equally old
                    out.append((*unit, content))
                elif (like[0], like[3]) < (doc, start):
                    out.append((*unit, None))
                else:
                    out.append((*like[:5], None))
                    seen[content] = (*unit, content)
            if len(out) > 20_000:
                yield made(out)
                out = []
            if len(seen) > 100_000:  # hand on what is held: later likes are new ones, which the shard resolves
                yield made(list(seen.values()))
                seen = {}
        yield made(out + list(seen.values()))

    def made(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * 6
        kinds = (*[pa.int64()] * 5, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["doc", "text_hash", "anchor", "start", "n_windows", "content"])

    return cut_lineage(rows.mapInArrow(cut, f"doc long, {_UNIT}"))


def _search(units: pa.Table, window: int) -> pa.Table:
    """Intervals of repeated words in the units of one shard."""
    units = units.sort_by([("doc", "ascending"), ("start", "ascending")])
    # equal units are indexed once, the earliest; all words of the younger ones are repeats
    index_of: dict[bytes, int] = {}
    earliest_like = np.array([index_of.setdefault(c, i) for i, c in enumerate(units.column("content").to_pylist())])
    doc, first = (units.column(c).to_numpy() for c in ("doc", "start"))
    copies = np.flatnonzero((doc != doc[earliest_like]) | (first != first[earliest_like]))
    copied = pa.table({
        "doc": doc[copies], "text_hash": units.column("text_hash").to_numpy()[copies], "begin": first[copies],
        "end": first[copies] + units.column("n_windows").to_numpy()[copies] + window - 1,
    })
    keep = np.ones(len(doc), bool)
    keep[copies] = False
    units = units.filter(pa.array(keep))
    contents = units.column("content").to_pylist()
    lengths = np.array([len(c) // _WORD_BYTES for c in contents])
    raw = np.zeros((int(lengths.sum()), 8), np.uint8)
    raw[:, :_WORD_BYTES] = np.frombuffer(b"".join(contents), np.uint8).reshape(-1, _WORD_BYTES)
    alphabet, symbols = np.unique(raw.view("<u8").ravel(), return_inverse=True)
    starts = np.cumsum(lengths) - lengths
    doc, first = (units.column(c).to_numpy() for c in ("doc", "start"))

    # the indexed text: each unit followed by a separator, symbol 0
    gap = np.arange(len(lengths))
    text = np.zeros(len(symbols) + len(lengths), np.int64)
    place = np.arange(len(symbols)) + np.repeat(gap, lengths)
    text[place] = symbols + 1
    index = FMIndex(text, len(alphabet) + 1, window)
    match, row = index.matching_statistics(symbols + 1, starts, lengths)

    unit_of = np.repeat(gap, lengths)
    inside = np.arange(len(symbols)) - starts[unit_of]
    full = np.flatnonzero(match >= window)
    earliest = index.first[index.class_of[row[full]]]
    owner = np.searchsorted(starts + gap, earliest, "right") - 1
    ages = doc[owner], first[owner] + earliest - (starts + gap)[owner]
    own = doc[unit_of[full]], first[unit_of[full]] + inside[full]
    again = full[(ages[0] < own[0]) | ((ages[0] == own[0]) & (ages[1] < own[1]))]
    breaks = np.flatnonzero((np.diff(again) != 1) | (np.diff(unit_of[again]) != 0)) + 1
    heads, tails = (again[np.concatenate(x).astype(np.int64)] for x in (([0], breaks), (breaks - 1, [-1]))) if len(again) else (again, again)
    u = unit_of[heads]
    searched = pa.table({
        "doc": doc[u], "text_hash": units.column("text_hash").to_numpy()[u],
        "begin": first[u] + inside[heads], "end": first[u] + inside[tails] + window,
    })
    return pa.concat_tables([copied, searched])


def _keyed(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """``doc_id, doc, text, text_hash``: ``doc`` orders documents, and with the hash it names their rows."""
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63)))
    return docs.select(F.col(id_column).alias("doc_id"), doc.alias("doc"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("text_hash"))


def repeated_intervals(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = WINDOW,
                       anchor: int = ANCHOR, max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """``doc, text_hash, begin, end``: word intervals of documents that occur earlier (they may touch or overlap)."""
    spark = batches(docs.sparkSession)
    rows = _keyed(docs, text, id_column)
    anchors = spark.sparkContext.broadcast(_repeated_anchors(rows, window, anchor, max_bytes))
    repeated = _repeated_windows(rows, window, anchor, anchors)
    planes = spark.sparkContext.broadcast((anchors.value, repeated))
    units = _units(rows, window, anchor, planes)
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = units.where("content is not null").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    searched = found.groupBy("shard").applyInArrow(
        lambda shard: _search(shard, window), "doc long, text_hash long, begin long, end long"
    )
    whole = units.where("content is null").select(
        "doc", "text_hash", F.col("start").alias("begin"),
        (F.col("start") + F.col("n_windows") + (window - 1)).alias("end"),
    )
    return searched.unionByName(whole)


def kept_words(text: bytes, intervals: list) -> tuple[list[bytes], int]:
    """The words outside the intervals, and how many there were."""
    found = text.split()
    if not intervals:
        return found, len(found)
    keep = np.ones(len(found), bool)
    for begin, end in intervals:
        keep[begin:end] = False
    return [w for w, k in zip(found, keep) if k], len(found)


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = WINDOW,
                   anchor: int = ANCHOR, max_bytes: int = bloom.MAX_BYTES, texts: bool = True) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, kept_text`` (kept words, one space between).

    Without ``texts`` the last is null: for those who need the digest only.
    """
    found = repeated_intervals(docs, text, id_column, window, anchor, max_bytes)
    per_doc = found.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("begin", "end")).alias("cuts"))
    per_doc = cut_lineage(per_doc)
    rows = _keyed(docs, text, id_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(per_doc, ["doc", "text_hash"], "left").select("doc_id", "text", "cuts")

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts = batch.column("cuts").to_pylist()
        out = []
        for raw, found in zip(utf8(batch, "text"), cuts):
            kept, n = kept_words(raw, [(c["begin"], c["end"]) for c in found or ()])
            joined = b" ".join(kept)
            out.append((n, n - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if texts else None))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )

    return map_batches(joined, remove, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d),
repeats AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM starts)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
cut AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM repeats) GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS n_gone,
         CASE WHEN gone IS NULL THEN w ELSE list_transform(
           list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(gone, p)), lambda p: w[p]) END AS rest
  FROM d LEFT JOIN cut USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_gone AS BIGINT) AS n_removed,
       sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept
"""
