"""Best-fit packing of token sequences by minimum bin slack.

What a packing decides depends on the lengths alone. Documents are tokenised and
cut into pieces once; the counts of pieces by length, at most ``capacity``
numbers whatever the corpus, are all that the driver sees. Bin by bin, the
fullest feasible combination with the longest piece left is found by bitset
subset-sum dynamic programming over the available lengths, and taken out as
often as the counts allow. The resulting patterns, a few per length, are sent to
the tasks, which look up the bin and the offset of each piece by its number
among the pieces of its length. These numbers come from counts per task and
length and a prefix sum over tasks, so pieces of one length are never gathered.

Strings of added tokens (say, ``<|endoftext|>``) in a text are ordinary text: the
vocabulary's own instructions read it with ``encode_special_tokens``, and no id of
an added token is ever made. Ids come from the faster of two installed libraries
for one vocabulary; tests compare the two over whole tables.

Rows, one by one: a null text counts as empty and gives the end token alone; a
text of any length is tokenised whole and cut, its first piece taking the
remainder; equal rows and ids are packed each for itself, a null id is kept; an
empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import batches, utf8
from feedlens.session import cut_lineage

CAPACITY = 1024
END_ID = 2
_SHIFT = 40  # a piece's number within its length takes the low bits of a slot key


# --- tokens ------------------------------------------------------------------


def encoder(path: str):
    """Text to ids for a byte-level BPE vocabulary file in JSON.

    Ids of such a vocabulary rank its merges, so the faster of the two installed
    libraries can use them; a text that it refuses goes to the other one.
    """
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    ordinary = {c for r in (range(33, 127), range(161, 173), range(174, 256)) for c in r}
    others = [c for c in range(256) if c not in ordinary]
    byte = {chr(c): c for c in ordinary} | {chr(256 + i): c for i, c in enumerate(others)}
    special = {x["content"] for x in found.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): rank for token, rank in found["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = []

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except BaseException as error:  # a panic of its regular expressions is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
        if not slow:
            slow.append(Tokenizer.from_file(path))
            slow[0].encode_special_tokens = True
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def cut_points(n_ids: int, capacity: int = CAPACITY) -> list[int]:
    """Starts of the pieces of a document, and its end: whole pieces, the remainder first."""
    return [0, *range(n_ids - capacity * ((n_ids - 1) // capacity), n_ids, capacity), n_ids]


def pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", id_column: str = "doc_id",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` with ``part, nth``, written to the shared folder.

    ``nth`` numbers the pieces of one length within the task ``part``.
    """
    batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in stream:
            out: list[tuple] = []
            for i, raw in enumerate(utf8(batch, "text")):
                ids = np.array([*encode(raw.decode("utf-8", "replace")), end_id], "<u4")
                points = cut_points(len(ids), capacity)
                for piece, (start, end) in enumerate(zip(points, points[1:])):
                    length = end - start
                    out.append((i, piece, start, length, zlib.crc32(ids[start:end].tobytes()), part, seen[length]))
                    seen[length] += 1
            if out:
                index, *columns = zip(*out)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(index)), *map(pa.array, columns, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    ))


# --- bins --------------------------------------------------------------------


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths that together fill ``room`` best, by bitset subset-sum over the available lengths.

    Longer lengths come first, and the search ends where the room is filled, so
    that of equally full combinations one with long pieces is taken.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, bundle = min(int(counts[length]), room // length), 1
        while left > 0:
            bundle = min(bundle, left)
            steps.append((length, bundle, reach))
            reach |= reach << bundle * length & mask
            left, bundle = left - bundle, 2 * bundle
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, bundle, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * bundle
            total -= length * bundle
    return out


def minimum_bin_slack(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins) for counts of pieces by length."""
    counts = counts.copy()
    plan = []
    while counts.any():
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        items = [longest, *fullest(counts, capacity - longest)]
        counts[longest] += 1
        need = np.bincount(items, minlength=len(counts))
        used = np.flatnonzero(need)
        times = int((counts[used] // need[used]).min())
        counts -= need * times
        plan.append((items, times))
    return plan


def slots(plan: list[tuple[list[int], int]], capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """(length, first number, first bin, offset) rows of a plan, sorted: where the pieces of a length go."""
    used, first_bin, rows = [0] * (capacity + 1), 0, []
    for items, times in plan:
        offset = 0
        for length in items:
            rows.append((length, used[length], first_bin, offset))
            used[length] += times
            offset += length
        first_bin += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return tuple(table.T)


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", id_column: str = "doc_id",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = pieces(docs, tokenizer_path, text, id_column, capacity, end_id)
    per_task = cut_lineage(cut.groupBy("part", "length").agg((F.max("nth") + 1).alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    length, first, first_bin, offset = slots(minimum_bin_slack(counts, capacity), capacity)
    slot_keys = length << _SHIFT | first

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = cut_lineage(per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    numbered = cut.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("number")
    )

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            number = batch.column("number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(slot_keys, batch.column("length").to_numpy(zero_copy_only=False) << _SHIFT | number,
                                 "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first_bin[at] + number - first[at]), pa.array(offset[at])],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    kind = cut.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
