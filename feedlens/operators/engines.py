"""Plug-in point for text engines written in Python.

An engine is ``fn(texts: pd.Series) -> pd.DataFrame`` with one output row per
input text, in order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BatchTextFn = Callable[[pd.Series], pd.DataFrame]


def call_with_retry(fn: BatchTextFn, texts: pd.Series, tries: int, pause: float) -> pd.DataFrame | None:
    """The engine's answer, or ``None`` when every try fails."""
    for attempt in range(tries):
        try:
            return fn(texts)
        except Exception:  # noqa: BLE001 - engines fail in their own ways
            if attempt + 1 < tries:
                time.sleep(pause)
    return None


def answer_each(fn: BatchTextFn, texts: pd.Series, tries: int, pause: float) -> Iterator[tuple[pd.Series, pd.DataFrame | None]]:
    """The texts in parts, each with its answer, or ``None`` for a single text the engine cannot take.

    A batch that fails is halved, down to single texts: one bad text among n costs
    about 2 log2(n) further calls and no other text. Halves are tried once; a
    single text gets all its tries, so an engine that is down for a while comes back.
    """
    texts = texts.reset_index(drop=True)
    answer = call_with_retry(fn, texts, tries if len(texts) == 1 else 1, pause)
    if answer is not None and len(answer) != len(texts):
        answer = None  # rows that cannot be told apart count as a failure
    if answer is not None or len(texts) == 1:
        yield texts, answer
        return
    half = len(texts) // 2
    yield from answer_each(fn, texts[:half], tries, pause)
    yield from answer_each(fn, texts[half:], tries, pause)


def run_on_distinct_texts(
    messages: DataFrame,
    setup: Callable[[], BatchTextFn],
    schema: T.StructType,
    text: str = "text",
    tries: int = 10,
    pause: float = 10.0,
    failed: str | None = None,
) -> DataFrame:
    """Add the engine's columns to each message; they are null where it failed.

    ``failed`` names a further column: whether the engine could not take the text
    (false for an empty or null text, which it is not given).

    Every distinct text is sent once: copies are reduced inside each task before
    the exchange. ``setup`` runs once per task. Filter before, since Catalyst
    moves no predicate through Python.
    """
    given = F.col(text).isNotNull() & (F.col(text) != "")
    distinct = messages.where(given).select(F.col(text).alias("_text")).distinct()
    flag = T.StructField("_failed", T.BooleanType())
    out = T.StructType([T.StructField("_text", T.StringType()), flag, *schema.fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = setup()
        for batch in batches:
            for texts, answer in answer_each(fn, batch["_text"], tries, pause):
                missing = answer is None
                if missing:
                    answer = pd.DataFrame({n: [None] * len(texts) for n in names})
                answer = answer[names].reset_index(drop=True)
                answer.insert(0, "_text", texts.to_numpy())
                answer.insert(1, "_failed", missing)
                yield answer

    # the hash leads the join key: sorting and probing compare eight bytes, not
    # texts; a text with very many copies is split by the adaptive skew join
    answers = distinct.mapInPandas(run, out).withColumn("_hash", F.xxhash64("_text"))
    same = (F.xxhash64(text) == F.col("_hash")) & (F.col(text) == F.col("_text"))
    joined = messages.join(answers, same, "left").drop("_hash", "_text")
    if failed is not None:
        joined = joined.withColumn(failed, F.coalesce("_failed", F.lit(False)))
    return joined.drop("_failed")
