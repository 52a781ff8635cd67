"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint has 64 bits. Two that differ in at most three bits agree on at
least one of the four 16-bit blocks, and of the two halves of the remaining 48
bits one holds at most one of the differences. In the perfect binary Golay code
[23, 12, 7] every 23-bit word lies within distance 3 of exactly one codeword, so
a word one bit away lies within distance 4 of that codeword. Each fingerprint
therefore gives, for each of the eight (block, half) pairs, the key of its own
codeword and the keys of all codewords within distance 4 (one or six). Own keys
joined with near keys meet every pair within three bits; the distance is then
verified. No pair is missed.

Fingerprints are made distinct first, so copies never meet each other. Keys
are held by distinct fingerprints only; what a key's fingerprints link to leaves
the task as a spanning forest, not as all pairs. Every join is a sorted merge
(``merged``): a fingerprint has some fifty keys, which Spark would size as the
fingerprint alone, and no table made here is bounded.

Rows, one by one: a null or wordless text has fingerprint zero and links like any
other; a text of one or two words is one shingle; equal rows share a fingerprint
and so a component; a null id never becomes a component's id unless all are null;
texts are read whole; other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import batches, map_batches, merged, unused, utf8, with_fields
from feedlens.llm.components import components
from feedlens.session import cut_lineage

SHINGLE = 3
SEED = 42
MAX_BITS = 3  # the guarantee of the keys; fewer are verified from the same keys
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

#: bits of each byte value, most significant first
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


# --- fingerprints ------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, as an unsigned number."""
    found = text.lower().split()
    if not found:
        return 0
    parts = map(b" ".join, zip(*(found[i:] for i in range(shingle)))) if len(found) >= shingle else [b" ".join(found)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), np.uint64)
    columns = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    set_bits = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) of every row, written once to the shared folder."""
    batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, shingle) for t in utf8(batch, "text")], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return cut_lineage(map_batches(rows, mark, f"doc_id {kind}, fp long"))


# --- the code ----------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    left = np.array(words, np.int64)
    for bit in range(22, 10, -1):
        left ^= np.where(left >> bit & 1, GENERATOR << (bit - 11), 0)
    return left


class Golay:
    """Error patterns by syndrome: the one of weight up to 3, and those of weight 4."""

    def __init__(self):
        units = 1 << np.arange(23, dtype=np.int64)
        light = np.array([sum(int(units[i]) for i in c) for w in range(4) for c in combinations(range(23), w)])
        four = np.array([sum(int(units[i]) for i in c) for c in combinations(range(23), 4)])
        self.leader = np.zeros(2048, np.int64)
        self.leader[_syndrome(light)] = light
        by = _syndrome(four)
        order = np.argsort(by, kind="stable")
        per = np.bincount(by, minlength=2048)
        self.per_four = per
        self.fours = np.zeros((2048, per.max()), np.int64)
        column = np.arange(len(order)) - np.repeat(np.cumsum(per) - per, per)
        self.fours[by[order], column] = four[order]

    def own(self, words: np.ndarray) -> np.ndarray:
        """Index of the codeword within distance 3 of each word."""
        return (words ^ self.leader[_syndrome(words)]) >> 11

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, index) of every codeword within distance 4 of each word."""
        marks = _syndrome(words)
        rows = np.arange(len(words))
        more, column = np.nonzero(np.arange(self.fours.shape[1])[None, :] < self.per_four[marks][:, None])
        index = (words[more] ^ self.fours[marks[more], column]) >> 11
        return np.concatenate([rows, more]), np.concatenate([self.own(words), index])


def segments(fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(pair number, exact 16-bit block, 23-bit half of the rest) for the eight pairs."""
    unsigned = fps.view(np.uint64)
    blocks = [(unsigned >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    for i in range(4):
        a, b, c = (blocks[j] for j in range(4) if j != i)
        rest = a << 32 | b << 16 | c
        for half in range(2):  # of 24 bits; a difference in the bit left out only helps
            yield 2 * i + half, blocks[i], rest >> 24 * half & 0x7FFFFF


def own_keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of the eight own keys of every fingerprint."""
    made = [pair << 28 | block << 12 | code.own(half) for pair, block, half in segments(fps)]
    return np.concatenate(made), np.tile(np.arange(len(fps)), len(made))


def near_keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of all codewords near each of the eight halves of every fingerprint."""
    made, of = [], []
    for pair, block, half in segments(fps):
        rows, index = code.near(half)
        made.append(pair << 28 | block[rows] << 12 | index)
        of.append(rows)
    return np.concatenate(made), np.concatenate(of)


# --- links and groups --------------------------------------------------------


def _keyed(distinct: DataFrame, make, name: str) -> DataFrame:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in stream:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            if len(fps):
                key, row = make(fps, code)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[row])], names=["key", name])

    return distinct.select("fp").mapInArrow(run, f"key long, {name} long")


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints at most ``max_bits`` apart, each at least once."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys are complete up to {MAX_BITS} bits")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    own, others = _keyed(distinct, own_keys, "a"), _keyed(distinct, near_keys, "b")
    return own.join(merged(others), (own["key"] == others["key"]) & near).select("a", "b")


def _labels(marked: DataFrame, max_bits: int) -> DataFrame:
    """``fp, component_id`` of every distinct fingerprint."""
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(distinct, max_bits))
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    members = cut_lineage(
        found.unionByName(roots).join(merged(distinct), F.col("node") == F.col("fp")).select("fp", "component", "first")
    )
    least = cut_lineage(members.groupBy("component").agg(F.min("first").alias("component_id")))
    linked = cut_lineage(members.join(merged(least), "component").select("fp", "component_id"))
    return cut_lineage(
        distinct.join(merged(linked), "fp", "left")
        .select("fp", F.coalesce("component_id", "first").alias("component_id"))
    )


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id`` (smallest id of its group)."""
    marked = fingerprints(docs, text, id_column, shingle)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(merged(_labels(marked, max_bits)), "fp").select("doc_id", hexed, "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id.

    Of rows that share this id and the fingerprint one stays, the first by text.
    """
    marked = fingerprints(docs, text, id_column, shingle)
    fp, place, keep = unused(docs, "fp"), unused(docs, "place"), unused(docs, "keep_id")
    keepers = (
        marked.join(merged(_labels(marked, max_bits)), "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id").agg(F.min("fp").alias(fp)).withColumnRenamed("component_id", keep)
    )
    keepers = cut_lineage(keepers)

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, shingle) for t in utf8(batch, text)], np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made.view(np.int64))],
                                          names=[*batch.schema.names, fp])

    tagged = map_batches(docs, mark, with_fields(docs.schema, (fp, "long")))
    same = tagged[fp].eqNullSafe(keepers[fp]) & tagged[id_column].eqNullSafe(keepers[keep])
    kept = tagged.join(merged(keepers), same, "left_semi")
    best = Window.partitionBy(fp, id_column).orderBy(text)
    return kept.withColumn(place, F.row_number().over(best)).where(F.col(place) == 1).select(docs.columns)
