"""Quality by histogram gradient-boosted trees over document statistics.

Statistics of the text alone (``STATISTICS``) are computed where it is read. Trees
are boosted on a bounded sample of labelled rows (``PER_CLASS`` of each class):
statistics are binned at quantiles of the sample, each level of a tree splits at
the best bin by histograms of gradients. The trees are complete binary trees
flattened into arrays, (trees, nodes), and a batch of documents walks all trees
at once in as many numpy steps as they are deep. Scoring is one pass over the
texts without exchange.

Rows, one by one: a null text counts as empty and gets the score of its
statistics, all zero; texts are read whole; equal texts get equal scores; without
labelled rows of both classes every score is the share of label 1 among those
there are, or 0.5; an empty table gives no rows; other columns are kept by
``add_scores``, whatever their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlens.llm.common import batches, map_batches, send, utf8, with_fields
from feedlens.llm.labelled import known_labels, sample_ids, sample_texts

PER_CLASS = 10_000
TREES, DEPTH, RATE = 80, 4, 0.15
BINS = 64
LEAST_HESSIAN, RIDGE = 4.0, 1.0

_KINDS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (9, 10, 11, 12, 13, 32),
    "newline": (10,), "full_stop": b".", "comma": b",", "exclamation": b"!", "bar": b"|", "symbol": b"#$%&*+=@^~_",
    "bracket": b"<>[]{}()", "slash": b"/\\:", "high": range(128, 256),
}
_MASKS = np.zeros((256, len(_KINDS)))
for _i, _bytes in enumerate(_KINDS.values()):
    _MASKS[list(_bytes), _i] = 1
STATISTICS = (
    "bytes", *(f"{kind}_share" for kind in _KINDS), "words", "word_bytes", "distinct_words", "distinct_pairs",
    "repeated_neighbours", "distinct_lines", "line_bytes", "long_words", "sentence_ends", "compressed",
)


def statistics(text: bytes) -> list[float]:
    """The statistics of a text, shares being of its bytes, words or lines."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MASKS / n
    found = text.split()
    lines = text.split(b"\n")
    m, pairs = max(len(found), 1), max(len(found) - 1, 1)
    joined = list(zip(found, found[1:]))
    return [
        np.log1p(n), *kinds.tolist(), np.log1p(len(found)), sum(map(len, found)) / m, len(set(found)) / m,
        len(set(joined)) / pairs, sum(a == b for a, b in joined) / pairs, len(set(lines)) / len(lines),
        n / len(lines), sum(len(w) > 20 for w in found) / m, sum(w.endswith((b".", b"!", b"?")) for w in found) / m,
        len(zlib.compress(text, 1)) / n,
    ]


@dataclass
class Trees:
    """Complete trees as arrays: node ``i`` has the children ``2 i + 1`` and ``2 i + 2``."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): above it to the right
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        if not len(self.leaf) or not len(x):
            return np.full(len(x), self.base)
        tree, row = np.arange(len(self.leaf))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        depth = int(np.log2(self.leaf.shape[1]))
        for _ in range(depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.base + self.leaf[tree, node - (self.leaf.shape[1] - 1)].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -50, 50)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
              bins: int = BINS, weight: np.ndarray | None = None) -> Trees:
    """Boosting with logistic loss on binned columns."""
    n, width = x.shape
    weight = np.ones(n) if weight is None else weight
    share = np.average(y, weights=weight) if n else 0.5
    base = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / np.clip(1 - share, 1e-3, 1 - 1e-3)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    if n == 0 or y.min() == y.max():
        empty = np.zeros((0, inner), np.int64)
        return Trees(empty, empty.astype(float), np.zeros((0, leaves)), base)
    edges = np.quantile(x, np.arange(1, bins) / bins, axis=0)  # (bins - 1, width)
    binned = np.stack([np.searchsorted(edges[:, f], x[:, f], "left") for f in range(width)], axis=1)
    cell = binned + np.arange(width) * bins
    margin = np.full(n, base)
    feature, threshold, leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            wide, first = 1 << level, (1 << level) - 1
            at = ((node - first) * width * bins)[:, None] + cell
            size = wide * width * bins
            sums = [
                np.bincount(at.ravel(), np.repeat(v, width), size).reshape(wide, width, bins).cumsum(axis=2) for v in (g, h)
            ]
            left_g, left_h = (s[:, :, :-1] for s in sums)
            all_g, all_h = (s[:, :, -1:] for s in sums)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
            best = gain.reshape(wide, -1).argmax(axis=1)
            f, b = best // (bins - 1), best % (bins - 1)
            splits = gain.reshape(wide, -1).max(axis=1) > 1e-9
            features[first:first + wide] = f
            cuts[first:first + wide] = np.where(splits, edges[b, f], np.inf)  # without a split all go left
            node = 2 * node + 1 + (x[np.arange(n), features[node]] > cuts[node])
        place = node - inner
        values = -rate * np.bincount(place, g, leaves) / (np.bincount(place, h, leaves) + RIDGE)
        margin += values[place]
        feature.append(features), threshold.append(cuts), leaf.append(values)
    return Trees(np.array(feature), np.array(threshold), np.array(leaf), base)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, label: str = "quality",
          text: str = "text", id_column: str = "doc_id", per_class: int = PER_CLASS, **settings) -> Trees:
    """Learns from labelled rows outside the held-out fold (crc32 of the id modulo ``modulus``).

    Where the bound of a class takes only a part of its rows, the rows it takes
    weigh as much as all of them, so scores keep the shares of the classes.
    """
    batches(docs.sparkSession)
    known = known_labels(labels, label, modulus, remainder, id_column).where("target IN (0, 1)")
    sizes = {row["target"]: row["count"] for row in known.groupBy("target").count().collect()}  # two rows
    sample = sample_texts(docs, sample_ids(labels, label, modulus, remainder, per_class, id_column), text, id_column)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [statistics(t) for t in utf8(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [pa.array(made, pa.list_(pa.float64())), batch.column("target"), batch.column("doc_id")],
            names=["x", "y", "doc_id"],
        )

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = map_batches(sample, measure, f"x array<double>, y int, doc_id {kind}").toPandas()  # at most two bounds
    rows = rows.sort_values("doc_id", kind="stable")
    y = rows["y"].to_numpy(float)
    x = np.array(rows["x"].tolist()).reshape(len(y), len(STATISTICS))
    weight = np.ones(len(y))
    for c, size in sizes.items():
        weight[y == c] = size / max(1, min(size, per_class))
    return fit_trees(x, y, weight=weight / max(weight.min(initial=np.inf), 1e-9) if len(y) else weight, **settings)


def add_scores(docs: DataFrame, trees: Trees, name: str, text: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``name``."""

    def score(batch: pa.RecordBatch, trees: Trees) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in utf8(batch, text)]).reshape(-1, len(STATISTICS))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.scores(x))],
                                          names=[*batch.schema.names, name])

    return map_batches(docs, score, with_fields(docs.schema, (name, "double")), send(docs.sparkSession, trees))
