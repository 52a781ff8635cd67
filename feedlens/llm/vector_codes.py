"""Vector codes by product quantisation, codebooks fitted over metric trees.

Components become whole numbers and vectors are cut into equal parts. Every chunk
of vectors gets one metric tree per part over its distinct part vectors, by an
anchors hierarchy built from the middle out: anchors are picked one by one (each
the point farthest from the anchor of the widest ball, taking over the points
that are nearer to it; the triangle inequality spares most distances), the balls
of the anchors are then merged upwards, always the two whose union is smallest,
and each is split further the same way. A ball holds the sum and count of its
points.

Assignment walks down the trees, all balls of a level side by side. A ball
inherits the list of entries that can still be nearest to one of its points; an
entry leaves the list if the bisecting plane to a nearer one lies beyond the ball
(on the plane it stays, so ties are settled by the points). A ball with one entry
left is wholly owned: its cached sum and count, or its points, go to the entry at
once. Leaves with longer lists compare their points with the entries left. All
comparisons that decide are made in whole numbers.

How it scales: trees are built once, written to the shared folder and read by
each round, so no vector is parsed twice. A task hands on one row per part and
entry, which one small exchange adds up. The driver holds the codebooks (parts x
entries x components) and nothing else; so do the tasks, besides one chunk.

Rows: vectors that are null, empty or hold null or non-finite components are
dropped, as are those of another width than the vector with the smallest id;
fewer than ``entries`` vectors make a smaller codebook; equal ids are ordered by
their vectors, a null id comes last; rows that repeat are coded each for itself;
an empty table gives no rows; other columns are ignored. The width must be a
multiple of ``parts`` and components below ``LARGEST`` in size; anything else is
an error.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import batches, received, send
from feedlens.session import cut_lineage, spread

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK_BYTES = 4 << 20  # of whole-number components in the vectors of one chunk of trees
CHUNK_ROWS = 8192
LEAF = 64  # distinct part vectors that are not split further
LARGEST = 2.0**20


# --- trees -------------------------------------------------------------------


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, the place of each row among them, and how often they occur."""
    low = rows.min(axis=0)
    bits = [int(n).bit_length() for n in rows.max(axis=0) - low]
    if sum(bits) > 62:
        points, place, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        return points, place.ravel(), weight
    key = np.zeros(len(rows), np.int64)  # a row as one number
    for column, n in enumerate(bits):
        key = key << n | rows[:, column] - low[column]
    _, first, place, weight = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return rows[first], place, weight


def _squared(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number points."""
    gap = points - pivot
    return np.einsum("ij,ij->i", gap, gap)


def anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """The points (as indexes) of at most ``most`` anchors, none empty."""
    pivots = np.empty((most, points.shape[1]), points.dtype)
    pivots[0], k = points[0], 1
    near = _squared(points, points[0])
    owner = np.zeros(len(points), np.int64)
    widest = np.zeros(most, np.int64)  # never below an anchor's radius, and looked up anew for the widest only
    widest[0] = near.max()
    while k < most:
        wide = int(widest.argmax())
        mine = np.flatnonzero(owner == wide)
        far = near[mine]
        last = int(far.argmax())
        if far[last] < widest[wide]:
            widest[wide] = far[last]
            continue
        if not far[last]:  # all points are anchors
            break
        pivots[k] = pivot = points[mine[last]]
        apart = _squared(pivots[:k], pivot)
        able = np.flatnonzero(4 * near > apart[owner])  # others are nearer to their anchor than half way
        far = _squared(points[able], pivot)
        taken = far < near[able]
        able, far = able[taken], far[taken]
        owner[able], near[able], widest[k] = k, far, far.max()
        k += 1
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.cumsum(np.bincount(owner, minlength=k))[:-1])


def _merge_order(points: np.ndarray, groups: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of balls to merge, the two with the smallest union first; merged balls are numbered on."""
    k = len(groups)
    size = np.array([len(g) for g in groups], float)
    center = np.array([points[g].mean(axis=0) for g in groups])
    radius = np.array([np.sqrt(_squared(points[g], c).max()) for g, c in zip(groups, center)])
    name = np.arange(k)

    def union(i: int) -> np.ndarray:
        gap = center - center[i]
        apart = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        share = size[i] / (size + size[i])
        both = np.maximum(apart * share + radius, apart * (1 - share) + radius[i])
        both[i] = np.inf
        return both

    table = np.array([union(i) for i in range(k)])
    out = []
    for step in range(k - 1):
        i, j = sorted(divmod(int(table.argmin()), len(table)))
        out.append((int(name[i]), int(name[j])))
        reach = table[i, j]
        center[i] = (center[i] * size[i] + center[j] * size[j]) / (size[i] + size[j])
        size[i] += size[j]
        radius[i], name[i] = reach, k + step
        size[j], center[j], radius[j] = 1.0, 0.0, np.inf  # out of the game
        table[j, :] = table[:, j] = np.inf
        table[i, :] = table[:, i] = union(i)
    return out


@dataclass
class Tree:
    """Balls over the distinct points of a chunk's part, which are ordered so that a ball is a stretch of them."""

    points: np.ndarray  # (distinct, width)
    weight: np.ndarray  # (distinct,) how often each occurs
    place: np.ndarray  # (rows,) the point of each row of the chunk
    low: np.ndarray  # (balls,) the stretch of a ball; the root comes first
    high: np.ndarray
    child: np.ndarray  # (balls, 2) -1 for a leaf
    radius: np.ndarray  # (balls,) around the mean of its distinct points

    def __post_init__(self):
        wide = self.points.astype(np.int64)
        for_prefix = np.zeros((1, wide.shape[1]), np.int64)
        sums = np.vstack([for_prefix, np.cumsum(wide * self.weight[:, None], axis=0)])
        plain = np.vstack([for_prefix, np.cumsum(wide, axis=0)])
        counts = np.concatenate([[0], np.cumsum(self.weight, dtype=np.int64)])
        self.sum, self.count = sums[self.high] - sums[self.low], counts[self.high] - counts[self.low]
        self.center = (plain[self.high] - plain[self.low]) / (self.high - self.low)[:, None]

    @classmethod
    def of(cls, rows: np.ndarray) -> Tree:
        points, place, weight = distinct(rows)
        order: list[np.ndarray] = []
        balls: list[list[int]] = []  # low, high, one child, other child
        done = 0

        def leaf(group: np.ndarray) -> int:
            nonlocal done
            order.append(group)
            balls.append([done, done + len(group), -1, -1])
            done += len(group)
            return len(balls) - 1

        def ball(group: np.ndarray) -> int:
            if len(group) <= LEAF:
                return leaf(group)
            inner = points[group]
            parts = anchors(inner, max(2, min(int(len(group) ** 0.5), 2 * len(group) // LEAF)))
            pairs = _merge_order(inner, parts)
            # from the top down, so that every ball is one stretch
            def down(name: int) -> int:
                if name < len(parts):
                    return ball(group[parts[name]])
                at = len(balls)
                balls.append([done, 0, -1, -1])
                one, other = pairs[name - len(parts)]
                balls[at][2], balls[at][3] = down(one), down(other)
                balls[at][1] = done
                return at

            return down(len(parts) + len(pairs) - 1)

        ball(np.arange(len(points)))
        order_ = np.concatenate(order)
        back = np.empty(len(order_), np.int64)
        back[order_] = np.arange(len(order_))
        low, high, *child = np.array(balls, np.int32).T
        points = points[order_]
        tree = cls(_narrow(points), weight[order_].astype(np.int32), back[place].astype(np.int32),
                   low, high, np.stack(child, axis=1), np.zeros(len(low)))
        tree.radius = tree._radii()
        return tree

    def _radii(self) -> np.ndarray:
        """Of all balls of one depth at once, since those do not overlap."""
        out, level = np.zeros(len(self.low)), np.array([0])
        while len(level):
            size = self.high[level] - self.low[level]
            first = np.cumsum(size) - size
            at = np.repeat(self.low[level] - first, size) + np.arange(size.sum())
            gap = self.points[at] - np.repeat(self.center[level], size, axis=0)
            out[level] = np.sqrt(np.maximum.reduceat(np.einsum("ij,ij->i", gap, gap), first))
            below = self.child[level]
            level = np.sort(below[below >= 0])
        return out * (1 + 1e-12)

    def owned(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(balls, entry of each, True) for balls wholly owned, and (points, entry of each, False) for the rest."""
        book = entries.astype(float)
        apart = np.sqrt(((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2))
        norm = (book * book).sum(axis=1)
        ball, able = np.array([0]), np.zeros((1, len(book)), bool)
        able[0, np.unique(entries, axis=0, return_index=True)[1]] = True  # of equal entries the first stands for all
        while len(ball):
            center = self.center[ball]
            own = (center * center).sum(axis=1)
            gap = own[:, None] - 2 * center @ book.T + norm[None, :]
            gap[~able] = np.inf
            best = gap.argmin(axis=1)
            least = gap[np.arange(len(ball)), best]
            slack = 1e-9 * (1 + own + norm.max())
            with np.errstate(invalid="ignore"):
                able &= gap - least[:, None] <= 2 * self.radius[ball][:, None] * apart[best] + slack[:, None]
            whole = able.sum(axis=1) == 1
            if whole.any():
                yield ball[whole], able[whole].argmax(axis=1), True
            ball, able = ball[~whole], able[~whole]
            end = self.child[ball, 0] < 0
            if end.any():
                size = self.high[ball[end]] - self.low[ball[end]]
                at = np.repeat(self.low[ball[end]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                yield at, nearest(self.points[at], entries, np.repeat(able[end], size, axis=0))[0], False
            ball, able = self.child[ball[~end]].ravel(), np.repeat(able[~end], 2, axis=0)

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum and the count of the rows of each entry."""
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        for at, entry, is_ball in self.owned(entries):
            if is_ball:
                add, n = self.sum[at], self.count[at]
            else:
                n = self.weight[at].astype(np.int64)
                add = self.points[at].astype(np.int64) * n[:, None]
            np.add.at(sums, entry, add)
            np.add.at(counts, entry, n)
        return sums, counts

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each row of the chunk, and its squared distance."""
        entry_of = np.empty(len(self.points), np.int64)
        for at, entry, is_ball in self.owned(entries):
            if is_ball:
                for ball, e in zip(at.tolist(), entry.tolist()):
                    entry_of[self.low[ball] : self.high[ball]] = e
            else:
                entry_of[at] = entry
        gap = self.points.astype(np.int64) - entries[entry_of]
        far = (gap * gap).sum(axis=1)
        return entry_of[self.place], far[self.place]


def _narrow(values: np.ndarray) -> np.ndarray:
    small = np.iinfo(np.int16)
    fits = not values.size or (values.min() >= small.min and values.max() <= small.max)
    return values.astype(np.int16 if fits else np.int32)


def nearest(points: np.ndarray, entries: np.ndarray, able: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry among those able, the first of equals, and its squared distance, in whole numbers."""
    largest = max(np.abs(points.astype(np.int64)).max(initial=0), np.abs(entries).max(initial=0))
    exact = 4 * int(largest) ** 2 * points.shape[1] < 1 << 52
    p, e = (x.astype(float if exact else np.int64) for x in (points, entries))  # doubles hold these whole numbers
    far = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None, :]
    if able is not None:
        far[~able] = np.inf if exact else np.iinfo(np.int64).max
    at = far.argmin(axis=1)
    return at, far[np.arange(len(at)), at].astype(np.int64)


# --- vectors to chunks -------------------------------------------------------------


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    values = values.astype(np.float64)
    if values.size and not np.abs(values).max() < LARGEST:
        raise ValueError(f"a component is not below {LARGEST}")
    return np.floor(values * scale).astype(np.int64)


def chunks(rows: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """``trees binary, ids array, labels array``: the trees of every chunk of vectors, written to the shared folder."""
    most = max(64, min(CHUNK_ROWS, CHUNK_BYTES // (8 * width)))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(group: pa.Table) -> pa.RecordBatch:
            whole = whole_numbers(group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False), scale)
            whole = whole.reshape(group.num_rows, parts, -1)
            trees = pickle.dumps([vars(Tree.of(whole[:, p])) for p in range(parts)])
            border = pa.array([0, group.num_rows], pa.int32())
            lists = [pa.ListArray.from_arrays(border, group.column(c).combine_chunks()) for c in ("id", "label")]
            return pa.RecordBatch.from_arrays([pa.array([trees], pa.binary()), *lists], names=["trees", "ids", "labels"])

        for batch in stream:
            held.append(batch)
            while sum(b.num_rows for b in held) >= most:
                table = pa.Table.from_batches(held)
                yield made(table.slice(0, most))
                held = table.slice(most).to_batches()
        table = pa.Table.from_batches(held) if held else None
        if table is not None and table.num_rows:
            yield made(table)

    kind = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    return cut_lineage(rows.mapInArrow(run, f"trees binary, ids array<{kind['id']}>, labels array<{kind['label']}>"))


_STORED = ("points", "weight", "place", "low", "high", "child", "radius")


def _trees(packed: bytes) -> list[Tree]:
    return [Tree(**{k: v for k, v in one.items() if k in _STORED}) for one in pickle.loads(packed)]


# --- codebooks ---------------------------------------------------------------------


def _improved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the mean of its part vectors, rounded down; unused ones stay."""
    parts, entries, width = books.shape
    sent = send(trees.sparkSession, books)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = received(sent)
        sums, counts = np.zeros(now.shape, np.int64), np.zeros(now.shape[:2], np.int64)
        for batch in stream:
            for packed in batch.column(0):
                for p, tree in enumerate(_trees(packed.as_py())):
                    s, n = tree.totals(now[p])
                    sums[p] += s
                    counts[p] += n
        part, entry = np.nonzero(counts)
        if len(part):
            values = pa.array(sums[part, entry].ravel(), pa.int64())
            border = pa.array(np.arange(len(part) + 1) * width, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.ListArray.from_arrays(border, values),
                 pa.array(counts[part, entry], pa.int64())], names=["part", "entry", "sums", "n"],
            )

    totals = trees.select("trees").mapInArrow(run, "part int, entry int, sums array<long>, n long")
    added = totals.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )
    out = books.copy()
    for row in added.collect():  # at most parts x entries rows
        out[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return out


def fit(vectors: DataFrame, vector: str, id_column: str, label: str, parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray] | None:
    """The chunks of all usable vectors and the codebooks (parts, entries, components); None without any."""
    batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(_usable(F.col("vector")))
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()
    if not first:
        return None
    width = len(first[0]["vector"])
    if width % parts:
        raise ValueError(f"vectors of {width} components have no {parts} equal parts")
    rows = rows.where(F.size("vector") == width)
    start = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    books = whole_numbers(np.array([r["vector"] for r in start]), scale).reshape(len(start), parts, -1).transpose(1, 0, 2)
    trees = chunks(spread(rows), width, parts, scale)
    for _ in range(rounds):
        books = _improved(trees, books)
    return trees, books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", id_column: str = "vec_id", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector."""
    kind = {c: vectors.schema[c].dataType.simpleString() for c in (id_column, label)}
    fitted = fit(vectors, vector, id_column, label, parts, entries, rounds, scale)
    if fitted is None:
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind[id_column]}, code string, error long, label_error long, codebooks_sha256 string")
    trees, books = fitted
    sent = send(trees.sparkSession, books)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = received(sent)
        for batch in stream:
            for i, packed in enumerate(batch.column(0)):
                found = [tree.codes(now[p]) for p, tree in enumerate(_trees(packed.as_py()))]
                code = np.stack([c for c, _ in found], axis=1)
                error = sum(far for _, far in found)
                text = [bytes(c).hex() for c in code.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, 1).flatten(), batch.column(2).slice(i, 1).flatten(), pa.array(text, pa.string()),
                     pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"],
                )

    coded = cut_lineage(trees.mapInArrow(run, f"vec_id {kind[id_column]}, label {kind[label]}, code string, error long"))
    by_label = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


# --- the same in SQL -----------------------------------------------------------------


def _oracle_sql() -> str:
    far = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    sql = """
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isnan(x) OR isinf(x), true)), true)),
parts AS (
  SELECT r, part, list_transform(embedding[part * len(embedding) // 16 + 1 : (part + 1) * len(embedding) // 16],
         lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM kept, (SELECT unnest(range(16)) AS part)),
book0 AS (SELECT part, r - 1 AS entry, v FROM parts WHERE r <= 64)"""
    for n in range(3):
        sql += f""",
near{n} AS (
  SELECT p.r, p.part, min(CAST({far} AS BIGINT) * 64 + b.entry) AS m FROM parts p JOIN book{n} b ON b.part = p.part GROUP BY p.r, p.part)"""
        if n < 2:
            sql += f""",
sums{n} AS (
  SELECT part, entry, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (
    SELECT p.part, m % 64 AS entry, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM near{n} a JOIN parts p ON p.r = a.r AND p.part = a.part)
  GROUP BY part, entry, i),
book{n + 1} AS (
  SELECT b.part, b.entry, coalesce(s.v, b.v) AS v FROM book{n} b
  LEFT JOIN (SELECT part, entry, list(x ORDER BY i) AS v FROM sums{n} GROUP BY part, entry) s ON s.part = b.part AND s.entry = b.entry)"""
    return sql + """,
coded AS (
  SELECT r, string_agg(printf('%02x', m % 64), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM near2 GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded ON coded.r = kept.r, books
"""


ORACLE_SQL = _oracle_sql()
