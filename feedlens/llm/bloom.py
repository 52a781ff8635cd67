"""A Bloom filter of two planes over 64-bit hashes: what was seen, what was seen twice.

Tasks fill planes of their own. Planes are cut into blocks, and the blocks of
all tasks meet in an exchange, where "seen" planes are united and a bit set in
two of them goes to the "twice" plane. No repeat is ever missed; a value that
is not repeated may be reported. Only the united "twice" plane, whose size is
bounded by ``max_bytes``, reaches the driver and is broadcast. With more values
than that size serves, more values are reported and the exact step gets more
rows; the result stays the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BITS = 1 << 16
BLOCK_BYTES = BLOCK_BITS // 8
MAX_BYTES = 32 << 20
BITS_PER_VALUE = 16
PROBES = 2


def plane_bits(n_values: int, max_bytes: int = MAX_BYTES) -> int:
    """Bits of a plane: a power of two with room for the values, at most ``max_bytes``."""
    wanted = max(BLOCK_BITS, n_values * BITS_PER_VALUE)
    return min(1 << (wanted - 1).bit_length(), max(BLOCK_BITS, 1 << (max_bytes.bit_length() + 2)))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(probes, rows) bit positions of unsigned 64-bit hashes."""
    odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)[:PROBES]
    mixed = hashes[None, :] * odd[:, None]
    mixed ^= mixed >> np.uint64(29)
    return ((mixed >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64)


class Planes:
    """The two planes of one task."""

    def __init__(self, bits: int):
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Takes values in: what was taken in before, or comes twice, goes to the second plane as well."""
        found, counts = np.unique(hashes, return_counts=True)
        spots = positions(found, self.once.size * 8)
        again = (counts > 1) | _get(self.once, spots).all(axis=0)
        self._set(self.twice, spots[:, again].ravel())
        self._set(self.once, spots.ravel())

    @staticmethod
    def _set(plane: np.ndarray, spots: np.ndarray) -> None:
        np.bitwise_or.at(plane, spots >> 3, _BIT[spots & 7])


_BIT = np.left_shift(1, np.arange(8)).astype(np.uint8)


def _get(plane: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (plane[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 > 0


def contains(plane: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether all bits of each hash are set."""
    return _get(plane, positions(hashes, plane.size * 8)).all(axis=0)


def repeated_plane(df: DataFrame, read: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """The "twice" plane over all rows of ``df``; ``read`` takes a batch's hashes."""

    def fill(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in stream:
            if batch.num_rows:
                planes = planes or Planes(bits)
                planes.add(read(batch))
        if planes is not None:
            once, twice = planes.once.reshape(-1, BLOCK_BYTES), planes.twice.reshape(-1, BLOCK_BYTES)
            for block in np.flatnonzero(once.any(axis=1)):
                yield _row(int(block), once[block], twice[block])

    def unite(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in stream:
            for row in batch.to_pylist():
                once, twice = _bits(row["once"]), _bits(row["twice"])
                if row["block"] in held:
                    seen, again = held[row["block"]]
                    again |= twice | (seen & once)
                    seen |= once
                else:
                    held[row["block"]] = (once, twice)
        for block, (once, twice) in held.items():
            if twice.any():
                yield _row(block, once[:0], twice)

    n_blocks = bits // BLOCK_BITS
    parts = df.mapInArrow(fill, "block int, once binary, twice binary")
    # no adaptive merging of the exchange: its partitions hold planes, not rows
    united = parts.repartition(min(n_blocks, 256), "block").mapInArrow(unite, "block int, once binary, twice binary")
    plane = np.zeros((n_blocks, BLOCK_BYTES), np.uint8)
    for row in united.select("block", "twice").toLocalIterator():  # at most the size of one plane
        plane[row["block"]] = _bits(row["twice"])
    return plane.reshape(-1)


def _row(block: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), *(pa.array([_packed(x)], pa.binary()) for x in (once, twice))],
        names=["block", "once", "twice"],
    )


def _packed(block: np.ndarray) -> bytes:
    """The positions of a block's bits, two bytes each, or the block itself where that is shorter."""
    spots = np.flatnonzero(np.unpackbits(block, bitorder="little")).astype("<u2").tobytes()
    return spots if len(spots) < BLOCK_BYTES else block.tobytes()


def _bits(packed: bytes) -> np.ndarray:
    if len(packed) == BLOCK_BYTES:
        return np.frombuffer(packed, np.uint8).copy()
    block = np.zeros(BLOCK_BITS, np.uint8)
    block[np.frombuffer(packed, "<u2")] = 1
    return np.packbits(block, bitorder="little")
