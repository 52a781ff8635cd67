"""Connected components of a link table, by alternating large-star and small-star steps.

Each round hangs every node below the smallest node it sees, first from the side
of the larger neighbours, then from the side of the smaller ones, until only
stars are left (Kiveris et al., "Connected Components in MapReduce and Beyond").
Each task first replaces its links by a spanning forest. Every round is written
to the shared folder; minima come from partial aggregation and are joined back
from a written table by sorted merge, so that a node with very many links is
split by the adaptive skew join and no table goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import merged
from feedlens.session import cut_lineage


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) for the nodes of links ``a``-``b``, roots left out."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:  # hook each root to the smallest root seen across a link, then shorten the paths
        x, y = root[left], root[right]
        open_ = x != y
        if not open_.any():
            break
        left, right, x, y = left[open_], right[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(above := root[root], root):
            root = above
    away = root != np.arange(len(nodes))
    return nodes[away], nodes[root[away]]


def _local_forest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in stream:
        a, b = forest(
            np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)]),
            np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)]),
        )
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _hung(links: DataFrame, hub: str, minima: DataFrame) -> DataFrame:
    return links.join(merged(minima), hub)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    minima = cut_lineage(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("least")))
    larger = both.where("b > a")
    return _hung(larger, "a", minima).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    minima = cut_lineage(links.groupBy("a").agg(F.min("b").alias("least")))
    moved = _hung(links, "a", minima).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(minima.withColumnRenamed("least", "b")).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node with a link to another.

    ``links`` has two long columns; loops, repeats and either direction are fine,
    rows with a null are ignored, no rows give no rows.
    """
    first, second = links.columns
    links = links.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).where("a > b")
    kind = "a long, b long"
    links = cut_lineage(links.mapInArrow(_local_forest, kind))
    mark = _mark(links)
    while mark[0]:
        starred = cut_lineage(_large_star(links))
        links = cut_lineage(_small_star(starred).mapInArrow(_local_forest, kind))
        before, mark = mark, _mark(links)
        if before == mark:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
