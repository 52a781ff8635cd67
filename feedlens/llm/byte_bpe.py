"""Byte-level BPE encoding and decoding, words found without regular expressions.

Pre-tokenisation is a finite automaton over classes of code points. Each class is
a function from states to states; the few functions that compositions of them can
yield are numbered once, with a table of their products, so that the state before
every character of a batch is an associative scan over small integers: prefixes
within blocks, column by column for all blocks at once, then over the blocks.
What a state and a class say together is whether a token starts. The alternatives
of the pattern that look ahead (white space before a word, contractions) are
classes of their own, made by shifting the array.

The slices between two starts go through a cache of merged slices. Only new ones
are merged, pair by pair in order of rank: all new slices of one length side by
side, one merge in each per step, ranks of pairs in a hash table of arrays. Ids are kept with the byte at which each
token ends, and decoding copies all bytes of a batch by these offsets at once.

Work per row is independent: no exchange at all. Texts of a batch are scanned in
windows of ``WINDOW`` bytes that hand on their last state, so memory beyond the
batch's own texts and ids is bounded whatever a text's length. The cache is
emptied between batches when it holds ``CACHED`` slices. A slice without any
break (say, one word of many megabytes) takes some 50 bytes a byte while merged.

Rows, one by one: a null text counts as empty and has no tokens; null ids and
repeated rows and ids are kept, each row for itself; an empty table gives no rows;
other columns are ignored. A text that is not valid UTF-8 is read with U+FFFD for
what is not.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm.common import batches, received, send, utf8

WINDOW = 1 << 22
CACHED = 1 << 18
BLOCK = 256  # characters that one row of the scan takes in sequence
LONG = 64  # slices of more bytes are merged by a heap
FEW = 24  # so many new slices of one length are merged one by one
SLICES = 1 << 17  # slices that are cut and looked up at once

# --- the automaton -------------------------------------------------------------

RESET, LETTER, NUMBER, OTHER, GLUE, LONE, WHITE, SHORT, DOUBLE = range(9)
CLASSES = 9
NEW, GLUED, LETTERS, NUMBERS, OTHERS, WHITES, LAST, LAST_TWO = range(8)
STATES = 8

# White space of Unicode.
WHITE_SPACE = [(0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
               (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
# Letters and numbers that Unicode 16 has and Python's tables, of Unicode 15.1, do not.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
               (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
               (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
               (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
               (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, WHITE or OTHER for every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    found = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for ranges, value in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER), (WHITE_SPACE, WHITE)):
        for first, last in ranges:
            found[first : last + 1] = value
    return found


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a character, and whether a token starts with it."""
    if kind == RESET:
        return NEW, False
    if kind == GLUE:  # a blank that the next character's token takes
        return GLUED, True
    if kind == LONE:  # other white space before a word
        return NEW, True
    if kind == WHITE:
        return WHITES, state != WHITES
    if kind == LETTER and state == LAST_TWO:
        return LAST, False
    if kind == LETTER and state == LAST:
        return NEW, False
    if kind in (SHORT, DOUBLE):  # an apostrophe with the letters of a contraction behind it
        if state in (GLUED, OTHERS):
            return OTHERS, False
        return (LAST if kind == SHORT else LAST_TWO), True
    run = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS}[kind]
    return run, state not in (GLUED, run)


class Automaton:
    """The transition functions with their products, and the scan over them."""

    def __init__(self):
        self.classes = code_point_classes()
        self.starts = np.array([[_step(s, k)[1] for k in range(CLASSES)] for s in range(STATES)])
        single = [tuple(_step(s, k)[0] for s in range(STATES)) for k in range(CLASSES)]
        number = {tuple(range(STATES)): 0}  # the identity
        for function in single:
            number.setdefault(function, len(number))
        known = list(number)
        for function in known:  # grows until it is closed
            for step in single:
                product = tuple(step[s] for s in function)
                if product not in number:
                    number[product] = len(number)
                    known.append(product)
        self.of_class = np.array([number[f] for f in single], np.uint8)
        self.apply = np.array(known, np.uint8)
        self.product = np.array([[number[tuple(g[s] for s in f)] for g in known] for f in known], np.uint8)

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """The product of all functions up to and with each."""
        n = len(functions)
        if n <= BLOCK:
            out, so_far = np.empty(n, np.uint8), 0
            for i, f in enumerate(functions.tolist()):
                so_far = self.product[so_far, f]
                out[i] = so_far
            return out
        blocks = -(-n // BLOCK)
        grid = np.zeros((blocks, BLOCK), np.uint8)
        grid.ravel()[:n] = functions
        grid = np.ascontiguousarray(grid.T)
        for i in range(1, BLOCK):
            grid[i] = self.product[grid[i - 1], grid[i]]
        before = np.zeros(blocks, np.uint8)
        before[1:] = self.prefixes(grid[-1])[:-1]
        return self.product[before[None, :], grid].T.ravel()[:n]

    def kinds(self, points: np.ndarray, resets: np.ndarray) -> np.ndarray:
        """The class of each character; the last three lack what stands behind them."""
        kind = self.classes[points]
        kind[resets] = RESET
        later = np.zeros(len(kind) + 2, np.uint8)
        later[: len(kind)] = kind
        word = (later[1:-1] != WHITE) & (later[1:-1] != RESET)
        before_word = (kind == WHITE) & word
        kind[before_word] = np.where(points[before_word] == 0x20, GLUE, LONE)
        quote = np.flatnonzero(points == 0x27)
        if len(quote):
            far = np.zeros(len(points) + 2, points.dtype)
            far[: len(points)] = points
            far[resets] = 0
            one, two = far[quote + 1], far[quote + 2]
            kind[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
            pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            kind[quote[pair]] = DOUBLE
        return kind

    def token_starts(self, buffer: bytes, resets: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """The bytes at which tokens start in valid UTF-8; ``resets`` are bytes between two texts."""
        raw, state, out, at = np.frombuffer(buffer, np.uint8), NEW, [], 0
        while at < len(raw):
            end = at + window
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end += 1
            ahead = min(len(raw), end + 8)  # two more characters
            while ahead < len(raw) and raw[ahead] & 0xC0 == 0x80:
                ahead += 1
            points = np.frombuffer(buffer[at:ahead].decode("utf-8").encode("utf-32-le"), "<u4")
            where = np.flatnonzero((raw[at:ahead] & 0xC0) != 0x80) + at
            low, high = np.searchsorted(resets, [at, ahead])
            kind = self.kinds(points, np.searchsorted(where, resets[low:high]))
            n = int(np.searchsorted(where, end))
            kind, where = kind[:n], where[:n]
            after = self.apply[self.prefixes(self.of_class[kind]), state]
            before = np.empty(n, np.uint8)
            before[0], before[1:] = state, after[:-1]
            out.append(where[self.starts[before, kind]])
            state, at = int(after[-1]), end
        return np.concatenate(out) if out else np.zeros(0, np.int64)


# --- merging -------------------------------------------------------------------


def load_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a vocabulary file (base64 token and rank a line), with their ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one slice: the neighbours of lowest rank are joined first, the leftmost of equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + (1 << 40)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n: a heap of (rank, place) and a linked list of parts."""
    n = len(piece)
    after, before = array("q", range(1, n + 2)), array("q", range(-1, n))
    now = array("q", [-1]) * n  # rank of the pair that starts at a part, -1 for none

    def look(i: int) -> None:
        j = after[i]
        rank = ranks.get(piece[i : after[j]], -1) if j < n else -1
        now[i] = rank
        if rank >= 0:
            heapq.heappush(heap, rank << 40 | i)

    heap: list[int] = []
    for i in range(n - 1):
        look(i)
    while heap:
        top = heapq.heappop(heap)
        rank, i = top >> 40, top & (1 << 40) - 1
        if now[i] != rank:
            continue
        j = after[i]
        after[i], now[j] = after[j], -1
        if after[j] < n:
            before[after[j]] = i
        look(i)
        if before[i] >= 0:
            look(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Pairs:
    """Every pair of tokens that together are a token, with its rank; looked up for whole arrays."""

    NONE = np.int64(1 << 40)

    def __init__(self, ranks: dict[bytes, int]):
        self.width = max(ranks.values(), default=0) + 1
        self.byte = np.array([ranks.get(bytes([c]), 0) for c in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    values.append(rank)
        key, value = np.array(keys, np.int64), np.array(values, np.int64)
        self.shift = np.uint64(64 - max(8, 2 + len(keys).bit_length()))
        slot = self._slot(key)
        order = np.argsort(slot, kind="stable")
        self.key, self.value = key[order], value[order]
        count = np.bincount(slot, minlength=1 << (64 - int(self.shift)))
        self.first = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        self.deepest = int(count.max())

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where the two are no token."""
        key = (left * self.width + right).ravel()
        slot = self._slot(key)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(key), self.NONE)
        open_ = np.flatnonzero(at < end)
        for _ in range(self.deepest):
            if not len(open_):
                break
            here = at[open_]
            hit = self.key[here] == key[open_]
            out[open_[hit]] = self.value[here[hit]]
            at[open_] += 1
            open_ = open_[~hit & (here + 1 < end[open_])]
        return out.reshape(left.shape)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of slices of one length."""
        parts = self.byte[np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)]
        pairs = self.rank(parts[:, :-1], parts[:, 1:])
        row, out = np.arange(len(pieces)), [[]] * len(pieces)
        while len(row):
            rows = np.arange(len(row))
            at = pairs.argmin(axis=1) if pairs.shape[1] else np.zeros(len(row), np.int64)
            best = pairs[rows, at] if pairs.shape[1] else np.full(len(row), self.NONE)
            done = best == self.NONE
            for i, ids in zip(row[done].tolist(), parts[done].tolist()):
                out[i] = ids
            row, at, best, parts, pairs = row[~done], at[~done], best[~done], parts[~done], pairs[~done]
            if not len(row):
                break
            rows, n = np.arange(len(row)), parts.shape[1]
            parts[rows, at] = best
            column = np.arange(n - 1)[None, :]
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            column = column[:, : n - 2]
            pairs = np.take_along_axis(pairs, column + (column >= at[:, None]), axis=1)
            for side in (at - 1, at):
                on = np.flatnonzero((side >= 0) & (side < n - 2))
                place = side[on]
                pairs[on, place] = self.rank(parts[on, place], parts[on, place + 1])
        return out


class Encoder:
    """Texts to ids and the bytes at which their tokens end."""

    def __init__(self, ranks: dict[bytes, int], automaton: Automaton, pairs: Pairs):
        self.ranks, self.automaton, self.pairs = ranks, automaton, pairs
        self.size = np.zeros(max(ranks.values(), default=0) + 1, np.int32)
        for token, rank in ranks.items():
            self.size[rank] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}  # slice -> its number in the lists below
        self.flat, self.first, self.count = array("i"), array("q"), array("i")

    def _learn(self, pieces: list[bytes]) -> None:
        """Merges new slices and remembers them."""
        by_length: dict[int, list[bytes]] = {}
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:
                self._keep(piece, [whole])
            else:
                by_length.setdefault(len(piece), []).append(piece)
        for length, group in by_length.items():
            if length > LONG or len(group) <= FEW:
                merged = [merge(piece, self.ranks) for piece in group]
            else:
                merged = self.pairs.merge(group)
            for piece, ids in zip(group, merged):
                self._keep(piece, ids)

    def _keep(self, piece: bytes, ids: list[int]) -> None:
        self.place[piece] = len(self.first)
        self.first.append(len(self.flat))
        self.count.append(len(ids))
        self.flat.extend(ids)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte of its text at which each token ends, and the number of ids by text."""
        if len(self.first) > CACHED or len(self.flat) > 16 * CACHED:
            self._forget()
        buffer = b"\n".join([*texts, b""])
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        resets = np.cumsum(length + 1) - 1
        start = self.automaton.token_starts(buffer, resets)
        border = np.searchsorted(start, resets)  # tokens up to the end of each text
        stop = np.empty_like(start)
        stop[:-1] = start[1:]
        text_end = border[np.diff(border, prepend=0) > 0] - 1
        stop[text_end] = resets[np.diff(border, prepend=0) > 0]
        known = self.place.get
        which = np.empty(len(start), np.int64)
        for low in range(0, len(start), SLICES):
            high = low + SLICES
            slices = [buffer[a:b] for a, b in zip(start[low:high].tolist(), stop[low:high].tolist())]
            found = list(map(known, slices))
            if None in found:
                self._learn(list(dict.fromkeys(s for s, n in zip(slices, found) if n is None)))
                found = list(map(known, slices))
            which[low:high] = found
        first, count, flat = (np.array(x, t) for x, t in ((self.first, np.int64), (self.count, np.int64), (self.flat, np.int32)))
        n_ids, begin = count[which], first[which]
        done = np.cumsum(n_ids)
        total = int(done[-1]) if len(done) else 0
        ids = flat[np.repeat(begin - (done - n_ids), n_ids) + np.arange(total)] if total else np.zeros(0, np.int32)
        up_to = np.concatenate([[0], done])[border]
        per_text = np.diff(up_to, prepend=0)
        ends = np.cumsum(self.size[ids], dtype=np.int64)
        ends -= np.repeat(np.cumsum(length) - length, per_text)
        return ids, ends, per_text


def _valid(raw: bytes) -> bytes:
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode("utf-8")
    return raw


def encode(docs: DataFrame, ranks_path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, ids array<int>, ends array<long>``: the ids of every text and where their tokens end, in bytes.

    The file of ranks is read by the driver; ranks, their pairs and the automaton go
    to the tasks once (bounded by the vocabulary).
    """
    spark = batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    ranks = load_ranks(ranks_path)
    sent = send(spark, (ranks, Automaton(), Pairs(ranks)))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*received(sent))
        for batch in stream:
            if not batch.num_rows:
                continue
            ids, ends, per_text = encoder.encode(list(map(_valid, utf8(batch, "text"))))
            border = pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(border, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(border, pa.array(ends, pa.int64()))],
                names=["doc_id", "ids", "ends"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, ends array<long>")


# --- decoding --------------------------------------------------------------------


class Decoder:
    """Ids to bytes: the vocabulary in one buffer, copied by offsets."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.size = np.fromiter(map(len, by_id), np.int64, len(by_id))
        self.first = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray, ends: np.ndarray | None, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes in sequence, and the byte at which each row ends; ``border``: the ids before each row, and all.

        Offsets kept from encoding tell how long each token is; without them the
        vocabulary does.
        """
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        if ends is None:
            size = self.size[ids]
        else:
            size = np.diff(ends, prepend=0)
            first = border[:-1][np.diff(border) > 0]
            size[first] = ends[first]
        done = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(int(done[-1]), np.uint8)
        for low in range(0, len(ids), 1 << 20):  # the index of the copy is wider than what is copied
            high = min(low + (1 << 20), len(ids))
            a, b = done[low], done[high]
            out[a:b] = self.bytes[np.repeat(self.first[ids[low:high]] - done[low:high], size[low:high]) + np.arange(a, b)]
        return out, done[border]


def decode(encoded: DataFrame, ranks_path: str, id_column: str = "doc_id", ids: str = "ids",
           ends: str | None = "ends", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, decoded binary``, and the columns named in ``keep``; null ids count as none.

    An id that the vocabulary lacks is an error.
    """
    spark = batches(encoded.sparkSession)
    named = {"doc_id": id_column, **{c: c for c in keep}}
    rows = encoded.select(*[F.col(c).alias(name) for name, c in named.items()], F.col(ids).alias("ids"),
                          *([F.col(ends).alias("ends")] if ends else []))
    sent = send(spark, load_ranks(ranks_path))

    def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(received(sent))
        for batch in stream:
            if not batch.num_rows:
                continue
            numbers, border = flat(batch.column("ids"))
            offsets = flat(batch.column("ends"))[0] if ends else None
            out, stops = decoder.decode(numbers, offsets, border)
            decoded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(stops.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(named)], decoded.cast(pa.binary())], names=[*named, "decoded"]
            )

    schema = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in named)
    return rows.mapInArrow(run, f"{schema}, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, encoded and decoded again."""
    encoded = encode(docs, ranks_path, text, id_column).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), "ids", "ends",
    )
    decoded = decode(encoded, ranks_path, keep=("n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
