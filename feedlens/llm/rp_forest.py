"""Near-duplicate embeddings by a forest of random-projection trees.

Every tree splits the unit sphere recursively: a node projects its vectors on a
random direction of its own and cuts where the fewest pairs are left; vectors
within ``spill * sqrt(2 - 2 * threshold)`` of the cut go to both sides. That
length is a share of the largest distance of a link, so a cut parts few links
however dense the vectors lie. A node whose pairs no cut makes fewer, as its
vectors lie closer than that, is a leaf. Vectors that
share a leaf of any tree are compared, pairs with a cosine of at least
``threshold`` (in double precision) are linked, and links are united to
components.

The cuts come from a sample of at most ``sample_rows`` distinct vectors, those
with the smallest hash; every vector is indexed. A leaf is a function of the
vector alone, so each task knows all leaves of a vector, and a pair that shares
several leaves is counted in the first of them only: no pair has to leave the
task that found it. A leaf gives the number of links of each vector and a
spanning forest. A leaf with more than ``block_rows`` vectors is cut into blocks,
and each two blocks meet in a group of their own. The leaves that several trees
make of one dense group are nearly the same: vectors that share an earlier one
do not meet again in a later one.

Equal vectors are one node with a weight; their mutual links are counted, not
compared. Recall against brute force is tested.

Rows, one by one: a null or empty vector, one with a null or non-finite component
and a zero vector link with nothing and are components of their own; vectors of
different lengths never link; rows that repeat an id stay rows, a null id never
becomes a component's id unless all are null; an empty table gives no rows;
columns other than id and vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import batches, map_batches, received, send
from feedlens.llm.components import components, forest
from feedlens.session import cut_lineage

TREES, SPILL, SEED = 8, 0.5, 7
LEAF_ROWS, BLOCK_ROWS, SAMPLE_ROWS = 256, 2048, 1 << 15
LEAST_SAMPLE = 16  # sampled vectors of a leaf
CUTS = np.linspace(0.2, 0.8, 13)  # shares of a node's vectors below the cuts that are tried
MANY_LINKS = 16  # per vector: more are handled as a matrix


def usable(values: list | None) -> bytes | None:
    """A vector's components as bytes of doubles; none for a vector that links with nothing."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64) + 0.0  # no negative zeros
    with np.errstate(over="ignore"):
        norm = np.linalg.norm(vector / (np.abs(vector).max() or 1.0)) if np.isfinite(vector).all() else 0.0
    return vector.tobytes() if norm > 0 else None


def unit_rows(packed: list[bytes]) -> np.ndarray:
    """Unit vectors as rows, shorter ones filled up with zeros."""
    width = max(len(p) for p in packed) // 8
    rows = np.zeros((len(packed), width))
    for i, p in enumerate(packed):
        rows[i, : len(p) // 8] = np.frombuffer(p)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@dataclass
class Forest:
    """Trees as arrays over heap positions: directions, and the interval that goes to both sides."""

    directions: np.ndarray  # (trees, inner nodes, width)
    low: np.ndarray  # (trees, inner nodes)
    high: np.ndarray
    depth: int
    dense: list[int]  # leaves that are so because their vectors lie close together

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf of every row; leaves are numbered through all trees."""
        width = min(x.shape[1], self.directions.shape[2])
        rows, found = [], []
        for tree, directions in enumerate(self.directions):
            seen = x[:, :width] @ directions[:, :width].T if self.depth else None
            row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                value = seen[row, node]
                left, right = value <= self.high[tree, node], value >= self.low[tree, node]
                row, node = (np.concatenate([row[left], row[right]]),
                             np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]))
            rows.append(row)
            found.append(node - ((1 << self.depth) - 1) + (tree << self.depth))
        return np.concatenate(rows), np.concatenate(found)


def _best_cut(value: np.ndarray, margin: float) -> tuple[float, float]:
    """Of several cuts that which leaves the fewest pairs, and their share of all pairs."""
    ordered = np.sort(value)
    cuts = np.quantile(ordered, CUTS)
    left = np.searchsorted(ordered, cuts + margin, "right")
    right = len(ordered) - np.searchsorted(ordered, cuts - margin, "left")
    pairs = (left / len(ordered)) ** 2 + (right / len(ordered)) ** 2
    return cuts[pairs.argmin()], pairs.min()


def grow(sample: np.ndarray, n_rows: int, trees: int = TREES, spill: float = SPILL, leaf_rows: int = LEAF_ROWS,
         seed: int = SEED, threshold: float = 0.9) -> Forest:
    """A forest with leaves of about ``leaf_rows`` of ``n_rows`` vectors, as far as the sample and their spread allow."""
    wanted = int(np.ceil(np.log2(max(n_rows / leaf_rows, 1))))
    depth = min(wanted, int(np.log2(max(len(sample) / LEAST_SAMPLE, 1))))
    inner, width = (1 << depth) - 1, sample.shape[1]
    directions = np.random.default_rng(seed).standard_normal((trees, inner, width))
    low, high = np.zeros((trees, inner)), np.zeros((trees, inner))
    margin = spill * np.sqrt(max(2 - 2 * threshold, 0))
    least = max(LEAST_SAMPLE, leaf_rows * len(sample) / max(n_rows, 1))
    dense = []
    for tree in range(trees):
        inside, done = {0: np.arange(len(sample))}, {}
        for node in range(inner):
            rows = inside.pop(node)
            value = sample[rows] @ directions[tree, node]
            why = done.pop(node, "small" if len(rows) <= least else None)
            if why is None:
                cut, pairs = _best_cut(value, margin)
                low[tree, node], high[tree, node] = cut - margin, cut + margin
                why = "dense" if pairs >= 1 else None
            if why:  # all go to the left, down to the last level
                low[tree, node] = high[tree, node] = np.inf
                done[2 * node + 1] = why
            inside[2 * node + 1] = rows[value <= high[tree, node]]
            inside[2 * node + 2] = rows[value >= low[tree, node]]
        dense += [node - inner + (tree << depth) for node, why in done.items() if why == "dense"]
    return Forest(directions, low, high, depth, sorted(dense))


def _vectors(table: DataFrame, vector: str, id_column: str) -> DataFrame:
    """``vec_id, key, packed`` of every row; key and components are null for a vector that links with nothing."""
    rows = table.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("vector"))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [usable(v) for v in batch.column("vector").to_pylist()]
        keys = [None if p is None else hashlib.blake2b(p, digest_size=16).digest() for p in packed]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
            names=["vec_id", "key", "packed"],
        )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return cut_lineage(map_batches(rows, pack, f"vec_id {kind}, key binary, packed binary"))


def _members(leaves: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(rows, known leaves) whether a row is in a leaf."""
    out = np.zeros((len(leaves), len(known)), np.float32)
    at = np.minimum(np.searchsorted(known, leaves), len(known) - 1)
    row, column = np.nonzero(known[at] == leaves)
    out[row, at[row, column]] = 1
    return out


def _large_component(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the component of the row with the most links."""
    rows, columns = np.zeros(close.shape[0], bool), np.zeros(close.shape[1], bool)
    new = np.array([close.sum(axis=1).argmax()])
    while len(new):
        rows[new] = True
        fresh = np.flatnonzero(close[new].any(axis=0) & ~columns)
        columns[fresh] = True
        new = np.flatnonzero(close[:, fresh].any(axis=1) & ~rows)
    return rows, columns


def _in_leaf(left: tuple, right: tuple, leaf: int, threshold: float, same: bool) -> tuple[np.ndarray, ...]:
    """Weights of the links of both sides, for pairs that share no earlier leaf, and links that join what is linked."""
    (x, leaves_x, weight_x), (y, leaves_y, weight_y) = left, right
    close = x @ y.T >= threshold
    if same:
        close = np.triu(close, 1)
    n_links = np.count_nonzero(close)
    if n_links <= MANY_LINKS * sum(close.shape):
        i, j = np.nonzero(close)
        first = np.ones(len(i), bool)
        for a in range(0, len(i), 4096):
            p, q = leaves_x[i[a:a + 4096]], leaves_y[j[a:a + 4096]]
            shared = (p[:, :, None] == q[:, None, :]) & (p[:, :, None] >= 0) & (p[:, :, None] < leaf)
            first[a:a + 4096] = ~shared.any(axis=(1, 2))
        of_x, of_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        np.add.at(of_x, i[first], weight_y[j[first]])
        np.add.at(of_y, j[first], weight_x[i[first]])
        return of_x, of_y, i, j
    known = np.intersect1d(leaves_x, leaves_y)
    known = known[(known >= 0) & (known < leaf)]
    counted = close
    if len(known):
        counted = close & (_members(leaves_x, known) @ _members(leaves_y, known).T == 0)
    of_x, of_y = (counted @ weight_y.astype(float), weight_x.astype(float) @ counted)
    i, j = [], []
    if same:  # both sides are the same vectors
        close = close | close.T
    while np.count_nonzero(close) > MANY_LINKS * sum(close.shape):
        rows, columns = _large_component(close)
        a, b = np.flatnonzero(rows), np.flatnonzero(columns)
        i += [a, np.full(len(b), a[0])]
        j += [np.full(len(a), b[0]), b]
        close[a] = False
    a, b = np.nonzero(close)
    return of_x.astype(np.int64), of_y.astype(np.int64), np.concatenate([*i, a]), np.concatenate([*j, b])


def _compare(rows: pa.Table, threshold: float) -> pa.Table:
    """One leaf, or two blocks of one: ``a, b, links`` with b null for a count and links null for a link."""
    leaf = rows.column("leaf")[0].as_py()
    node, weight = (rows.column(c).to_numpy() for c in ("node", "weight"))
    packed = rows.column("packed").to_pylist()
    lists = rows.column("leaves").to_pylist()
    width = max(map(len, lists))
    leaves = np.full((len(lists), width), -1, np.int64)
    for i, found in enumerate(lists):
        leaves[i, : len(found)] = found
    x = unit_rows(packed)
    length = np.array([len(p) for p in packed])
    block = rows.column("block").to_numpy()
    block_a, block_b = (rows.column(c)[0].as_py() for c in ("block_a", "block_b"))
    counts, links = np.zeros(len(node), np.int64), [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for n in np.unique(length):
        a, b = (np.flatnonzero((length == n) & (block == k)) for k in (block_a, block_b))
        if not len(a) or not len(b):
            continue
        of_a, of_b, i, j = _in_leaf((x[a], leaves[a], weight[a]), (x[b], leaves[b], weight[b]), leaf, threshold,
                                    block_a == block_b)
        i, j = a[i], b[j]
        counts[a] += of_a
        counts[b] += of_b
        links.append(forest(node[i], node[j]) if len(i) else (np.empty(0, np.int64), np.empty(0, np.int64)))
    hit = np.flatnonzero(counts)
    a, b = (np.concatenate(side) for side in zip(*links))
    return pa.table({
        "a": np.concatenate([node[hit], a]),
        "b": pa.array(np.concatenate([node[hit], b]), mask=np.arange(len(hit) + len(a)) < len(hit)),
        "links": pa.array(np.concatenate([counts[hit], b]), mask=np.arange(len(hit) + len(a)) >= len(hit)),
    })


def _covers(indexed: DataFrame, dense: list[int]) -> dict[int, tuple[int, int]]:
    """Of each of these leaves: the earlier one with most of its rows, and how many."""
    if len(dense) < 2:
        return {}
    mine = F.array_intersect("leaves", F.array(*map(F.lit, dense)).cast("array<long>"))
    pairs = indexed.select(mine.alias("mine")).select("mine", F.explode("mine").alias("leaf"))
    pairs = pairs.select("leaf", F.explode("mine").alias("earlier")).where("earlier < leaf")
    best: dict[int, tuple[int, int]] = {}
    for r in pairs.groupBy("leaf", "earlier").count().collect():  # pairs of leaves, whose number the sample bounds
        if (r["count"], -r["earlier"]) > (best.get(r["leaf"], (0, 0))[1], -best.get(r["leaf"], (0, 0))[0]):
            best[r["leaf"]] = (r["earlier"], r["count"])
    return best


def near_duplicates(table: DataFrame, vector: str = "embedding", id_column: str = "vec_id", threshold: float = 0.9,
                    trees: int = TREES, spill: float = SPILL, leaf_rows: int = LEAF_ROWS,
                    block_rows: int = BLOCK_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    spark = batches(table.sparkSession)
    vectors = _vectors(table, vector, id_column)
    nodes = vectors.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.any_value("packed").alias("packed")
    )
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    n_nodes = nodes.count()
    sample = [bytes(r["packed"]) for r in nodes.orderBy(F.xxhash64("key"), "key").limit(sample_rows).select("packed").collect()]
    grown = grow(unit_rows(sample) if sample else np.zeros((0, 1)), n_nodes, trees, spill, leaf_rows,
                 threshold=threshold)
    sent = send(spark, grown)

    def index(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees_ = received(sent)
        for batch in stream:
            if batch.num_rows:
                row, leaf = trees_.leaves(unit_rows(batch.column("packed").to_pylist()))
                order = np.lexsort((leaf, row))
                ends = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(leaf[order]))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("node", "weight", "packed")), lists],
                    names=["node", "weight", "packed", "leaves"],
                )

    indexed = nodes.select("node", "weight", "packed").mapInArrow(
        index, "node long, weight long, packed binary, leaves array<long>"
    )
    placed = indexed.withColumn("leaf", F.explode("leaves"))
    large = {  # at most one entry per leaf, whose number the sample bounds
        r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().where(f"count > {block_rows}").collect()
    }
    covers = _covers(indexed, [leaf for leaf in grown.dense if leaf in large])
    plan = {}  # of a large leaf: the earlier leaf that most of its rows share, blocks of the other rows and of these
    for leaf, n in large.items():
        cover, old = covers.get(leaf, (-1, 0))
        plan[leaf] = (cover, -(-(n - old) // block_rows), -(-old // block_rows))
    found_plan = F.try_element_at(F.create_map(*(
        x for leaf, p in plan.items() for x in (F.lit(leaf), F.array(*map(F.lit, p)))
    )), F.col("leaf")) if plan else F.lit(None)
    placed = placed.withColumn("plan", F.coalesce(found_plan, F.array(F.lit(-1), F.lit(1), F.lit(0))).cast("array<long>"))
    cover, fresh, old = (F.get("plan", F.lit(k)) for k in range(3))
    is_old, spread_by = F.array_contains("leaves", cover), F.xxhash64("node", "leaf")
    placed = placed.withColumn(
        "block", F.when(is_old, fresh + F.pmod(spread_by, old)).otherwise(F.pmod(spread_by, fresh)).cast("int")
    ).withColumn("others", F.when(is_old, fresh).otherwise(fresh + old).cast("int")).where("others > 0")
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "leaf", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block",
        "node", "weight", "packed", "leaves",
    )
    found = cut_lineage(met.groupBy("leaf", "block_a", "block_b").applyInArrow(
        lambda rows: _compare(rows, threshold), "a long, b long, links long"
    ))
    counts = found.where("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b is not null").select("a", "b"))
    roots = joined.select(F.col("component").alias("node"), "component").distinct()
    members = cut_lineage(joined.unionByName(roots).join(nodes.select("node", "first"), "node"))
    least = members.groupBy("component").agg(F.min("first").alias("component_id"))
    named = cut_lineage(members.join(cut_lineage(least), "component").select("node", "component_id"))
    result = cut_lineage(
        nodes.select("node", "key", "first", "weight").join(named, "node", "left").join(cut_lineage(counts), "node", "left")
        .select("key", F.coalesce("component_id", "first").alias("component_id"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    alone = vectors.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    rows = vectors.where("key is not null").select("vec_id", "key").join(result, "key")
    return rows.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
