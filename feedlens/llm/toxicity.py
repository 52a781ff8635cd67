"""Toxicity by class-conditional Kneser-Ney word models.

Two interpolated Kneser-Ney bigram models, of toxic and of ordinary texts, back
off to unigrams of their class and these to one continuation distribution that
both share: in how many contexts of either class a word was seen. A rare
expression thus has nearly the same probability in both, and only what the
counts of one class support tells them apart. A word seen in too few texts
counts as its prefix of six, else four bytes, else as the unknown word. Each
pair of neighbours counts once in a text, so that a text repeating itself weighs
no more than another.

The difference of the two log-likelihoods per pair, the part of it that strongly
marked words contribute and the length are turned into a probability by a
logistic fit on labelled rows that were not counted.

What is learnt is bounded by parameters: ``PER_CLASS`` labelled rows of each
class, the ``MAX_WORDS`` words and prefixes of most texts, and the ``MAX_PAIRS``
word pairs whose shares of the two classes differ most; other pairs count through
their words only. Everything is scored in one pass over the texts, without exchange.

Rows, one by one: a null or wordless text has likelihood ratio 0 and length 0 and
gets the score the logistic fit gives it; texts are read whole; equal texts get
equal scores; without labelled rows of both classes every score is 0; an empty
table gives no rows; other columns are kept by ``add_scores``, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import batches, map_batches, send, utf8, with_fields
from feedlens.llm.labelled import sample_ids, sample_texts
from feedlens.session import cut_lineage

PER_CLASS = 12_000
MAX_WORDS = 1 << 16
MAX_PAIRS = 1 << 18
WORD_DISCOUNT, PAIR_DISCOUNT = 0.75, 4.0
MARKED = 3.0
CALIBRATION_FOLDS = 4
PREFIXES = (6, 4)
LEAST_TEXTS = 3  # a word of the model is in so many texts, whatever the size of the sample

#: punctuation of ASCII becomes a blank
_BLANKS = bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256))


def model_words(text: bytes) -> list[bytes]:
    return text.lower().translate(_BLANKS).split()


def unit(word: bytes, ids: dict[bytes, int]) -> int:
    """The id of a word the model lacks: of its longest known prefix, else 0."""
    for length in PREFIXES:
        if (found := ids.get(word[:length] + b"*")) is not None:
            return found
    return 0


def text_units(text: bytes, ids: dict[bytes, int]) -> list[int]:
    found = model_words(text)
    known = list(map(ids.get, found))
    return [unit(w, ids) if i is None else i for w, i in zip(found, known)] if None in known else known


@dataclass
class Model:
    """Counts by word id (0 is the unknown word) and by sorted word pair, per class (0 ordinary, 1 toxic)."""

    ids: dict[bytes, int]
    words: np.ndarray  # (2, V) pairs that a word ends
    leading: np.ndarray  # (2, V + 1) pairs that a word begins, the last for the start of a text
    contexts: np.ndarray  # (V,) distinct words before a word, in both classes
    pairs: np.ndarray  # (P,) first * (V + 1) + second
    pair_counts: np.ndarray  # (2, P)
    weights: np.ndarray | None = None  # of the logistic fit
    word_discount: float = WORD_DISCOUNT
    pair_discount: float = PAIR_DISCOUNT
    marked: float = MARKED

    def __post_init__(self):
        v = self.words.shape[1]
        self.start = v  # the id before a text's first word
        shared = (self.contexts + 1.0) / (self.contexts.sum() + v)
        self.unigrams, self.backoffs, self.kept = [], [], []
        for c in (0, 1):
            kept = np.maximum(self.words[c] - self.word_discount, 0) / max(self.words[c].sum(), 1.0)
            self.unigrams.append(kept + (1 - kept.sum()) * shared)
            first = self.pairs // (v + 1)
            kept = np.maximum(self.pair_counts[c] - self.pair_discount, 0) / np.maximum(self.leading[c][first], 1)
            self.backoffs.append(1 - np.bincount(first, kept, v + 1))
            self.kept.append(kept)

    def log_ratios(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: log P_toxic - log P_ordinary, the part of it in excess of ``marked`` per pair, the pairs.

        Texts come as lists of unit ids; each pair of neighbours counts once.
        """
        lengths = np.array([len(w) for w in found], np.int64)
        total, v = int(lengths.sum()), self.start
        if not total:
            return np.zeros(len(found)), np.zeros(len(found)), lengths
        ids = np.fromiter((i for units in found for i in units), np.int64, total)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[(np.cumsum(lengths) - lengths)[lengths > 0]] = v
        row = np.repeat(np.arange(len(found)), lengths)
        tagged = np.unique((row * (v + 1) + before) * (v + 1) + ids)
        key, row = tagged % (v + 1) ** 2, tagged // (v + 1) ** 2
        before, ids = key // (v + 1), key % (v + 1)
        at = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
        hit = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), bool)
        logs = []
        for c in (0, 1):
            p = self.backoffs[c][before] * self.unigrams[c][ids]
            p[hit] += self.kept[c][at[hit]]
            logs.append(np.log(p))
        ratio = logs[1] - logs[0]
        n = len(found)
        return (
            np.bincount(row, ratio, n), np.bincount(row, np.maximum(ratio - self.marked, 0), n),
            np.bincount(row, minlength=n),
        )

    def features(self, texts: list[bytes]) -> np.ndarray:
        ratio, marked, n = self.log_ratios([text_units(t, self.ids) for t in texts])
        size = np.maximum(n, 1)
        return np.column_stack([np.ones(len(texts)), ratio / size, marked / size, np.log1p(marked), np.log1p(n)])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -50, 50)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method for a logistic regression with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _texts_with(sample: DataFrame) -> DataFrame:
    """``word, n``: in how many texts a word, or a prefix of words, stands."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            seen: Counter = Counter()
            for text in utf8(batch, "text"):
                found = set(model_words(text))
                seen.update(found)
                seen.update({w[:length] + b"*" for w in found for length in PREFIXES if len(w) >= length})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
            )

    counted = sample.select("text").mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _pair_counts(sample: DataFrame, ids) -> DataFrame:
    """``first, second, c0, c1``: texts of each class with two neighbouring units; a text's start is the last id."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, v = ids.value, len(ids.value) + 1
        for batch in stream:
            parts: tuple[list, list] = ([], [])
            for text, target in zip(utf8(batch, "text"), batch.column("target").to_pylist()):
                found = np.array([v, *text_units(text, known)], np.int64)
                parts[target].append(np.unique(found[:-1] * (v + 1) + found[1:]))
            both = [np.unique(np.concatenate(p or [np.empty(0, np.int64)]), return_counts=True) for p in parts]
            keys = np.union1d(both[0][0], both[1][0])
            counts = np.zeros((2, len(keys)), np.int64)
            for c, (found, n) in enumerate(both):
                counts[c, np.searchsorted(keys, found)] = n
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys // (v + 1)), pa.array(keys % (v + 1)), pa.array(counts[0]), pa.array(counts[1])],
                names=["first", "second", "c0", "c1"],
            )

    counted = sample.mapInArrow(count, "first long, second long, c0 long, c1 long")
    return counted.groupBy("first", "second").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, label: str = "toxic",
          text: str = "text", id_column: str = "doc_id", per_class: int = PER_CLASS, max_words: int = MAX_WORDS,
          max_pairs: int = MAX_PAIRS) -> Model:
    """Learns from labelled rows outside the held-out fold (crc32 of the id modulo ``modulus``)."""
    spark = batches(docs.sparkSession)
    sample = cut_lineage(sample_texts(docs, sample_ids(labels, label, modulus, remainder, per_class, id_column), text, id_column))
    aside = F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id")), F.lit(CALIBRATION_FOLDS)) == 0
    counted = sample.where(~aside)

    top = _texts_with(counted).where(F.col("n") >= LEAST_TEXTS).orderBy(F.col("n").desc(), "word").limit(max_words)
    ids = {word: i for i, word in enumerate(top.select("word").toArrow().column(0).to_pylist(), 1)}  # max_words at most
    v = len(ids) + 1
    sent = spark.sparkContext.broadcast(ids)
    pairs = cut_lineage(_pair_counts(counted, sent))

    def spread(column: str, width: int, *sums) -> list[np.ndarray]:
        """Sums over pairs by word id: at most ``width`` rows."""
        found = pairs.groupBy(column).agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).toArrow()
        out = np.zeros((len(sums), width))
        out[:, found.column(0).to_numpy()] = [c.to_numpy() for c in found.columns[1:]]
        return list(out)

    contexts, *words_by = spread("second", v, F.count("*"), F.sum("c0"), F.sum("c1"))
    leading = spread("first", v + 1, F.sum("c0"), F.sum("c1"))
    # first those whose shares of the two classes differ most
    ordinary, toxic = (F.lit(float(max(words.sum(), 1.0))) for words in words_by)
    differ = F.abs(F.col("c1") / toxic - F.col("c0") / ordinary)
    kept = pairs.where(F.col("c0") + F.col("c1") > 1).orderBy(differ.desc(), "first", "second").limit(max_pairs)
    first, second, *by_class = (c.to_numpy() for c in kept.toArrow().columns)  # bounded by max_pairs
    key = first * (v + 1) + second
    order = np.argsort(key)
    model = Model(ids, np.array(words_by), np.array(leading), contexts, key[order],
                  np.array(by_class, np.float64)[:, order])

    def features(batch: pa.RecordBatch, model: Model) -> pa.RecordBatch:
        x = model.features(utf8(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [pa.array(x.tolist(), pa.list_(pa.float64())), batch.column("target")], names=["x", "y"]
        )

    counted_pairs = send(spark, model)
    fit = map_batches(sample.where(aside), features, "x array<double>, y int", counted_pairs).toPandas()  # a part of the sample
    if fit["y"].nunique() == 2 and (model.words.sum(axis=1) > 0).all():
        model.weights = logistic(np.array(fit["x"].tolist()), fit["y"].to_numpy(float))
    return model


def add_scores(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """``docs`` with the probability of being toxic in column ``name``."""

    def score(batch: pa.RecordBatch, model: Model) -> pa.RecordBatch:
        made = model.scores(utf8(batch, text))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=[*batch.schema.names, name])

    return map_batches(docs, score, with_fields(docs.schema, (name, "double")), send(docs.sparkSession, model))
