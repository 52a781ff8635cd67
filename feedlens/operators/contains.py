"""Exact "text contains phrase" join without comparing every pair.

The phrases become an Aho-Corasick automaton (``functions.automaton``), which finds
all of them in one pass over a text. Phrases that would make a larger automaton
than ``TABLE_BITS`` are dealt into several by hash, and the texts are passed over
once for each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.automaton import ANCHOR, Automaton
from feedlens.operators.joins import with_text_key
from feedlens.operators.sizing import rows_if_small
from feedlens.session import cut_lineage

MAX_INLINE_PHRASES = 10_000  # so many are fetched without looking at their size first
# Bits of one automaton's look-up table, 64 MB; each byte of a phrase's anchor takes a row of it.
TABLE_BITS = 1 << 29
ROW_BITS = 32 * 128  # for so many byte classes, of which real phrases have fewer
LEAST_PHRASES = 16  # of one automaton: fewer are not worth a pass
HELD_KEY = ["_held_1", "_held_2"]


def _finder(spark: SparkSession, phrases: list[str]):
    """A function of a text column: the phrases that each text contains."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps((phrases, Automaton([p.encode() for p in phrases]))))

    @F.arrow_udf("array<string>")
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, automaton = pickle.loads(sent.value)
        for column in texts:
            wide = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
            found = automaton.find([b"" if t is None else t for t in column.cast(wide).to_pylist()])
            yield pa.array([[names[i] for i in one] for one in found], pa.list_(pa.string()))

    return find


def _blocks(phrases: DataFrame, phrase: str) -> list[list[str]]:
    """The distinct phrases, in as many blocks as their automata need; a block is all that is fetched at once."""
    distinct = phrases.select(F.col(phrase).alias("_phrase")).distinct()
    few = rows_if_small(distinct, MAX_INLINE_PHRASES)
    if few is not None:
        listed = sorted(row["_phrase"] for row in few)
        rows = sum(min(len(p.encode()), ANCHOR) for p in listed)
        n = _needed(len(listed), rows)
        return [listed[i::n] for i in range(n)] if listed else []
    distinct = cut_lineage(distinct)
    size = distinct.agg(F.count("*").alias("n"), F.sum(F.least(F.octet_length("_phrase"), F.lit(ANCHOR))).alias("rows")).first()
    n = _needed(size["n"], size["rows"])
    spot = F.pmod(F.xxhash64("_phrase"), F.lit(n))
    return [sorted(r["_phrase"] for r in distinct.where(spot == i).collect()) for i in range(n)]


def _needed(phrases: int, rows: int) -> int:
    return max(1, min(-(-rows * ROW_BITS // TABLE_BITS), -(-phrases // LEAST_PHRASES)))


def contains_join(
    texts: DataFrame,
    text: str,
    phrases: DataFrame,
    phrase: str,
    force_shuffle: bool = False,
) -> DataFrame:
    """Every pair (row of ``texts``, row of ``phrases``) whose text contains the phrase.

    Null and empty phrases match nothing; rows of ``texts`` need no key. One
    automaton: its hits stand beside the text, and only rows with a hit meet the
    phrases; no text is shuffled while Spark can send the phrases to them.
    Several: hits go with a hash of the text only, and fetch their texts after they
    have met the phrases.
    """
    named = phrases.where(F.col(phrase).isNotNull() & (F.col(phrase) != ""))
    blocks = _blocks(named, phrase)
    if not blocks:
        return texts.join(named, F.lit(False))
    finders = [_finder(texts.sparkSession, block) for block in blocks]
    same = F.col("_held_phrase") == F.col(phrase)
    if len(finders) == 1 and not force_shuffle:
        met = texts.withColumn("_held_phrase", F.explode(finders[0](F.col(text))))
        return met.join(named, same).drop("_held_phrase")

    keyed = with_text_key(texts, F.col(text), names=HELD_KEY)

    def hits(find) -> DataFrame:
        return keyed.select(*HELD_KEY, F.explode(find(F.col(text))).alias("_held_phrase"))

    found = reduce(DataFrame.unionByName, map(hits, finders)).distinct()
    # written, the hits have a known size: while they are few Spark sends them to
    # the texts and shuffles no text
    pairs = cut_lineage(found.join(named, same).drop("_held_phrase"))
    holds: Column = F.contains(F.col(text), F.col(phrase))
    return keyed.join(pairs, HELD_KEY).where(holds).drop(*HELD_KEY)
