"""Cells of a grid that tell where a region's inside is known without ray casting.

A region is cut into square cells, some eight across its bounding box. A cell
that no edge of the region touches lies wholly inside or wholly outside: outside
cells are left out, inside cells need no further test. Each cell that an edge
touches carries a code for ``FINE`` x ``FINE`` smaller cells: outside, inside or
edge. Only points in edge cells, a narrow band along the border, are ray cast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE = 3  # a region's box is up to 2^COARSE cells wide, and more than half of that
FINE = 16  # smaller cells across a cell
EDGES = 1 << 14  # of a region, taken at a time
FINEST_LEVEL = -10  # cells of 1/1024 degree for the smallest regions

OUTSIDE, INSIDE, EDGE = "0", "1", "2"


def cell_of(value: Column) -> Column:
    """Index of the cell that holds a coordinate, on the grid of ``_level``."""
    return F.floor(value / _side()).cast("int")


def _side() -> Column:
    return F.pow(F.lit(2.0), F.col("_level"))


def with_level(shapes: DataFrame) -> DataFrame:
    """Adds ``_level``: the grid whose cells suit a region's box, as a power of two."""
    extent = F.greatest(F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0"))
    level = F.ceil(F.log2(F.when(extent > 0, extent))) - COARSE
    return shapes.withColumn("_level", F.greatest(F.coalesce(level, F.lit(FINEST_LEVEL)), F.lit(FINEST_LEVEL)).cast("int"))


class _Grid:
    """The smaller cells of one region: which are touched by an edge, which have their middle inside."""

    def __init__(self, edges: np.ndarray, box: np.ndarray, side: float):
        self.edges, self.side, self.step = edges, side, side / FINE
        (self.left, self.low), (right, top) = (np.floor(corner / side).astype(np.int64) for corner in (box[:2], box[2:]))
        self.shape = ((top - self.low + 1) * FINE, (right - self.left + 1) * FINE)
        self.touched, self.inside = np.zeros(self.shape, bool), np.zeros(self.shape, bool)
        for block in np.array_split(edges, len(edges) // EDGES + 1):
            self._touch(*block.T)
            self._cross(*block.T)

    def _touch(self, px, py, qx, qy) -> None:
        """An edge touches, in each row of cells, those beside the piece of it that lies in the row."""
        rows, columns = self.shape
        wide = self.side * 2.0**-20  # against rounding
        x0, y0 = self.left * self.side, self.low * self.side + np.arange(rows) * self.step
        bottom, top = y0 - wide, y0 + self.step + wide
        edge, row = np.nonzero((np.minimum(py, qy)[:, None] <= top) & (np.maximum(py, qy)[:, None] >= bottom))
        rise, run = (qy - py)[edge], (qx - px)[edge]
        flat = rise == 0
        ends = []
        for bound, of_flat in ((bottom, 0.0), (top, 1.0)):
            share = np.where(flat, of_flat, (bound[row] - py[edge]) / np.where(flat, 1.0, rise))
            ends.append(px[edge] + np.clip(share, 0.0, 1.0) * run)
        first = np.floor((np.minimum(*ends) - wide - x0) / self.step).astype(np.int64).clip(0, columns)
        after = np.floor((np.maximum(*ends) + wide - x0) / self.step).astype(np.int64).clip(-1, columns - 1) + 1
        depth = np.zeros((rows, columns + 1), np.int64)
        np.add.at(depth, (row, first), 1)
        np.add.at(depth, (row, after), -1)
        self.touched |= depth.cumsum(axis=1)[:, :-1] > 0

    def _cross(self, px, py, qx, qy) -> None:
        """A crossing turns all middles to its left in its row."""
        rows, columns = self.shape
        x = self.left * self.side + (np.arange(columns) + 0.5) * self.step
        y = self.low * self.side + (np.arange(rows) + 0.5) * self.step
        edge, row = np.nonzero((py[:, None] > y) != (qy[:, None] > y))
        at = px[edge] + (y[row] - py[edge]) * (qx - px)[edge] / (qy - py)[edge]
        turns = np.zeros((rows, columns + 1), np.int64)
        np.add.at(turns, (row, np.searchsorted(x, at)), 1)
        right_of = turns[:, ::-1].cumsum(axis=1)[:, ::-1]
        self.inside ^= right_of[:, 1:] % 2 > 0

    def cells(self) -> Iterator[tuple[int, int, str | None]]:
        """``cx, cy, codes`` of the cells that hold anything of the region."""
        code = np.where(self.touched, EDGE, np.where(self.inside, INSIDE, OUTSIDE))
        for j in range(0, self.shape[0], FINE):
            for i in range(0, self.shape[1], FINE):
                square = code[j:j + FINE, i:i + FINE]
                if (square != OUTSIDE).any():
                    whole = (square == INSIDE).all()
                    yield int(self.left) + i // FINE, int(self.low) + j // FINE, None if whole else "".join(square.ravel())


def _edges(rings: pa.ListScalar) -> np.ndarray:
    """(edges, 4) of the rings; edges at a point without coordinates are none."""
    made = [np.empty((0, 4))]
    for ring in rings.values or ():
        if ring.values is not None and len(ring.values):
            p = np.column_stack([ring.values.field(c).to_numpy(zero_copy_only=False) for c in "xy"])
            made.append(np.hstack([p, np.roll(p, -1, axis=0)]))
    every = np.concatenate(made)
    return every[np.isfinite(every).all(axis=1)]


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(batch.num_rows):
            box = np.array(list(batch["box"][n].as_py().values()), float)
            if not np.isfinite(box).all():
                continue
            found = list(_Grid(_edges(batch["rings"][n]), box, 2.0 ** batch["_level"][n].as_py()).cells())
            cx, cy, codes = zip(*found) if found else ((), (), ())
            same = pa.array([n] * len(found), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["_shape"].take(same), batch["_level"].take(same), pa.array(cx, pa.int32()),
                 pa.array(cy, pa.int32()), batch["box"].take(same), pa.array(codes, pa.string())],
                names=["_shape", "_level", "_cx", "_cy", "box", "_codes"])


def region_cells(shapes: DataFrame) -> DataFrame:
    """``_shape, _level, _cx, _cy, box, _codes`` of every cell that a region's inside or border reaches.

    ``shapes`` has ``_shape, rings, box, _level``. ``_codes`` is null where the whole
    cell is inside. A region whose box is not finite has no cell.
    """
    kind = f"_shape bigint, _level int, _cx int, _cy int, box {dict(shapes.dtypes)['box']}, _codes string"
    return shapes.select("_shape", "rings", "box", "_level").mapInArrow(_cells_of, kind)


def code_at(lon: Column, lat: Column) -> Column:
    """The code of the smaller cell around a point in its cell; inside where the whole cell is."""

    def place(value: Column, cell: Column) -> Column:
        return F.least(F.floor((value / _side() - cell) * FINE), F.lit(FINE - 1)).cast("int")

    at = place(lat, F.col("_cy")) * FINE + place(lon, F.col("_cx")) + 1
    return F.coalesce(F.substring(F.col("_codes"), at, 1), F.lit(INSIDE))
