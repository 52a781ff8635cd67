"""Subword lattice likelihood of documents.

The subwords are those of an existing vocabulary file, with their ranks as first
scores. A word is the sum over all its segmentations into subwords, each closed
by a word end: a forward recursion in log space over the lattice of its bytes.
Scores are re-estimated from the distinct words of the training documents by
expected subword counts over the same lattice (forward and backward). Words of
the training documents are arcs of the lattice as well: with counts discounted,
the weight that the discount frees goes to the segmentations. A text is the
product of its words and one end.

Texts are of several kinds: the training documents of each value of ``kind``
(say, their language; ``KINDS`` at most, rarer ones share the last) give counts
and subword scores of their own, discounted towards those of all. The result is
the text's marginal probability, summed over segmentations and kinds; the kind of
a scored text is no input.

How it scales: distinct words are counted by all tasks, gathered by an exchange
on the word, and the lattice is run once per distinct word, not per token. The
``head`` most frequent words go to every task; the other words of each document
meet their scores in a join on the word. A word hot enough to make a partition
hot is in the head. Only the subwords' expected counts (as many as the file has)
and the head (a parameter) reach the driver; word counts never do.

Rows, one by one: a null text counts as empty and has one token, its end; texts
and words are read whole, whatever their length; rows that repeat an id are
scored each for itself; a null id counts as empty text in the fold; where
nothing is learnt the first scores are used; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import batches, map_batches, received, send, train_remainder, utf8
from feedlens.session import cut_lineage

HEAD = 1 << 17
HELD_WORDS = 400_000  # distinct words that a task counts before it hands them on
ROUNDS = 2  # of re-estimation
SMOOTH = 0.1
KINDS = 8
UNITS = 1e6  # scores of rare words are summed in whole millionths: exact in any order
_BASE = np.uint64(0x100000001B3)


# --- subwords ----------------------------------------------------------------


def subwords(path: str) -> list[bytes]:
    """Lower-case subwords without blanks of a byte-level vocabulary file in JSON, by rank; all bytes are among them."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ordinary = {c for r in (range(33, 127), range(161, 173), range(174, 256)) for c in r}
    others = [c for c in range(256) if c not in ordinary]
    byte = {chr(c): c for c in ordinary} | {chr(256 + i): c for i, c in enumerate(others)}
    found: dict[bytes, None] = {}
    for token in sorted(vocabulary, key=vocabulary.get):
        piece = bytes(byte[c] for c in token if c in byte).lstrip(b" ")
        if piece and piece == piece.lower() and piece.split() == [piece]:
            found.setdefault(piece)
    found.update(dict.fromkeys(bytes([c]) for c in range(256)))
    return list(found)


@dataclass
class Arcs:
    """The subwords found in a batch of words, shorter words being filled up at their end."""

    length: np.ndarray  # (words,)
    single: np.ndarray  # (width, words): the subword of one byte at each start, -1 behind the word
    start: np.ndarray  # of the longer subwords, one entry each
    stop: np.ndarray
    row: np.ndarray
    piece: np.ndarray

    def some(self, rows: np.ndarray) -> Arcs:
        """The arcs of some of the words."""
        place = np.full(len(self.length), -1)
        place[rows] = np.arange(len(rows))
        on = place[self.row] >= 0
        return Arcs(self.length[rows], self.single[:, rows], self.start[on], self.stop[on], place[self.row[on]], self.piece[on])

    def by(self, at: np.ndarray) -> list[np.ndarray]:
        """Indexes of the arcs by the value (0 to width) of ``at``."""
        order = np.argsort(at, kind="stable")
        return np.split(order, np.searchsorted(at[order], np.arange(1, len(self.single) + 1)))


@dataclass
class Lattice:
    """Subwords with log scores (natural) in each of several kinds of text, and those of a word's end.

    Every byte is a subword.
    """

    pieces: list[bytes]
    scores: np.ndarray  # (pieces, kinds)
    ends: np.ndarray  # (kinds,)

    def __post_init__(self):
        # the subwords as a trie: a node per prefix, found by the prefix's hash
        nodes: dict[int, int] = {}
        for i, piece in enumerate(self.pieces):
            h = 0
            for n, byte in enumerate(piece, 1):
                h = (h * int(_BASE) + byte + 1) & 0xFFFFFFFFFFFFFFFF
                nodes[h] = i if n == len(piece) else nodes.get(h, -1)
        hashes, ends = np.fromiter(nodes, np.uint64), np.fromiter(nodes.values(), np.int64)
        order = np.argsort(hashes)
        self.hashes, self.piece_at = hashes[order], ends[order]
        self.padded = np.vstack([self.scores, np.zeros((1, self.scores.shape[1]))])  # the last behind a word's end

    @classmethod
    def of_ranks(cls, path: str, n_kinds: int) -> Lattice:
        pieces = subwords(path)
        weight = 1.0 / (np.arange(len(pieces)) + 2.0)
        scores = np.log(0.7 * weight / weight.sum())
        return cls(pieces, np.repeat(scores[:, None], n_kinds, axis=1), np.full(n_kinds, np.log(0.3)))

    def arcs(self, words: list[bytes]) -> Arcs:
        """All subwords of all words: each start walks down the trie until it leaves it."""
        width = max(map(len, words))
        length = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        values = np.ascontiguousarray(text.T).astype(np.uint64) + np.uint64(1)
        single = np.full((width, len(words)), -1)
        start, row = np.nonzero(np.arange(width)[:, None] < length)
        h, n, found = values[start, row], 1, []
        while len(start):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            live = self.hashes[at] == h
            start, row, h, at = start[live], row[live], h[live], at[live]
            ends = self.piece_at[at] >= 0
            if n == 1:
                single[start[ends], row[ends]] = self.piece_at[at[ends]]
            else:
                found.append((start[ends], start[ends] + n, row[ends], self.piece_at[at[ends]]))
            more = start + n < length[row]
            start, row = start[more], row[more]
            h, n = h[more] * _BASE + values[start + n, row], n + 1
        none = np.empty(0, np.int64)
        return Arcs(length, single, *(np.concatenate(x) for x in zip((none,) * 4, *found)))

    def forward(self, arcs: Arcs, kinds: slice) -> np.ndarray:
        """(width + 1, words, kinds) log sums over the segmentations of each prefix.

        The sum at a place is taken relative to its path by the last byte alone.
        """
        scores, width = self.padded[:, kinds], len(arcs.single)
        alpha = np.zeros((width + 1, len(arcs.length), scores.shape[1]))
        for stop, which in enumerate(arcs.by(arcs.stop)[1:], 1):
            alpha[stop] = alpha[stop - 1] + scores[arcs.single[stop - 1]]
            if len(which):
                row = arcs.row[which]
                other = alpha[arcs.start[which], row] + scores[arcs.piece[which]]
                alpha[stop] += self._others(other - alpha[stop, row], row, len(arcs.length))
        return alpha

    def backward(self, arcs: Arcs, kinds: slice) -> np.ndarray:
        """(width + 1, words, kinds) log sums over the segmentations of the rest from each start."""
        scores, width = self.padded[:, kinds], len(arcs.single)
        beta = np.zeros((width + 1, len(arcs.length), scores.shape[1]))
        for start, which in reversed(list(enumerate(arcs.by(arcs.start)[:-1]))):
            beta[start] = beta[start + 1] + scores[arcs.single[start]]  # 0 behind the word
            if len(which):
                row = arcs.row[which]
                other = beta[arcs.stop[which], row] + scores[arcs.piece[which]]
                beta[start] += self._others(other - beta[start, row], row, len(arcs.length))
        return beta

    @staticmethod
    def _others(relative: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Log of one plus the exponentials of each row."""
        weights = np.exp(relative)
        return np.log1p(np.stack([np.bincount(row, w, n) for w in weights.T], axis=1))

    def log_marginals(self, words: list[bytes]) -> np.ndarray:
        """(words, kinds) log probabilities (natural), a word's end included, over all segmentations."""
        out = np.zeros((len(words), len(self.ends)))
        for part in _by_length(words):
            arcs = self.arcs([words[i] for i in part])
            out[part] = self.forward(arcs, slice(None))[arcs.length, np.arange(len(part))]
        return out + self.ends - np.log1p(-np.exp(self.ends))  # a word is never empty

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """(pieces, kinds) expected uses of the subwords in ``counts`` (words, kinds) occurrences of the words."""
        out = np.zeros((len(self.pieces), len(self.ends)))
        for part in _by_length(words):
            arcs = self.arcs([words[i] for i in part])
            for kind in range(len(self.ends)):
                rows = np.flatnonzero(counts[part, kind])
                if len(rows):
                    out[:, kind] += self._uses(arcs.some(rows), kind, counts[part[rows], kind])
        return out

    def _uses(self, arcs: Arcs, kind: int, counts: np.ndarray) -> np.ndarray:
        alpha, beta = (f(arcs, slice(kind, kind + 1))[:, :, 0] for f in (self.forward, self.backward))
        scores, total = self.padded[:, kind], alpha[arcs.length, np.arange(len(arcs.length))]
        start, row = np.nonzero(arcs.single >= 0)
        start, stop = np.concatenate([start, arcs.start]), np.concatenate([start + 1, arcs.stop])
        piece = np.concatenate([arcs.single[start[: len(row)], row], arcs.piece])
        row = np.concatenate([row, arcs.row])
        use = np.exp(alpha[start, row] + scores[piece] + beta[stop, row] - total[row]) * counts[row]
        return np.bincount(piece, use, len(self.pieces))


def _by_length(words: list[bytes], cells: int = 1 << 16) -> Iterator[np.ndarray]:
    """Index groups of words of like length, of a bounded number of bytes unless a single word has more."""
    length = np.array([len(w) for w in words])
    order = np.argsort(length, kind="stable")
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and length[order[stop]] * (stop - start + 1) <= cells:
            stop = min(len(order), stop + max(1, (stop - start) // 4))
        yield order[start:stop]
        start = stop


# --- counts ------------------------------------------------------------------


def _kinds(rows: DataFrame) -> tuple[list, DataFrame]:
    """Training documents of each kind, and the rows with the number of their kind."""
    sizes = rows.where("train").groupBy("kind").count().orderBy(F.col("count").desc(), "kind")
    top = sizes.limit(KINDS).collect()
    last = max(len(top) - 1, 0)
    number = F.lit(last)
    for i, row in enumerate(top):
        number = F.when(F.col("kind").eqNullSafe(F.lit(row["kind"])), i).otherwise(number)
    docs = [row["count"] for row in top] or [0]
    docs[last] += rows.where("train").count() - sum(docs)
    return docs, rows.withColumn("kind", number.cast("int"))


def _word_counts(rows: DataFrame, n_kinds: int) -> DataFrame:
    """``word, c, c0, c1, ...``: uses in training documents, of all and of each kind, of every word of any document."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(n_kinds)]
        for batch in stream:
            learn, kinds = (batch.column(c).to_pylist() for c in ("train", "kind"))
            for text, train, kind in zip(utf8(batch, "text"), learn, kinds):
                found = text.lower().split()
                seen[kind].update(found if train else dict.fromkeys(found, 0))
            if sum(map(len, seen)) > HELD_WORDS:
                yield from handed(seen)
                seen = [Counter() for _ in range(n_kinds)]
        yield from handed(seen)

    def handed(seen: list[Counter]) -> Iterator[pa.RecordBatch]:
        for kind, counts in enumerate(seen):
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.binary()), pa.array([kind] * len(counts), pa.int32()),
                     pa.array(list(counts.values()), pa.int64())], names=["word", "kind", "n"],
                )

    counted = rows.select("text", "train", "kind").mapInArrow(count, "word binary, kind int, n long")
    each = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(n_kinds)]
    return cut_lineage(counted.groupBy("word").agg(F.sum("n").alias("c"), *each))


@dataclass
class Counts:
    """Words, distinct words and discount of the training documents of one kind, or of all."""

    words: int
    distinct: int
    discount: float

    @classmethod
    def of(cls, words: DataFrame, columns: list[str]) -> list[Counts]:
        sums = words.agg(*(
            x for i, c in enumerate(columns) for x in (
                F.coalesce(F.sum(c), F.lit(0)).alias(f"n{i}"), F.count_if(F.col(c) > 0).alias(f"v{i}"),
                F.count_if(F.col(c) == 1).alias(f"a{i}"), F.count_if(F.col(c) == 2).alias(f"b{i}"),
            )
        )).first()
        out = []
        for i in range(len(columns)):
            n, v, once, twice = (sums[f"{x}{i}"] for x in "nvab")
            share = once / (once + 2 * twice) if once else 0.5
            out.append(cls(n, v, min(max(share, 0.1), 0.95)))
        return out

    def kept(self, c: np.ndarray) -> np.ndarray:
        """The share of a word that its own count supports."""
        return np.maximum(c - self.discount, 0) / max(self.words, 1)

    def freed(self) -> float:
        """The share of all words that the discount has freed."""
        return self.discount * self.distinct / self.words if self.words else 1.0


def _re_estimated(words: DataFrame, lattice: Lattice, sizes: list[Counts]) -> Lattice:
    """Scores from the expected uses of the subwords in the distinct words of each kind."""
    sent = send(words.sparkSession, lattice)
    n_kinds = len(sizes)

    def expect(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = received(sent)
        total = np.zeros(lattice.scores.shape)
        for batch in stream:
            seen = [batch.column(f"c{k}").to_numpy(zero_copy_only=False) > 0 for k in range(n_kinds)]
            total += lattice.expected(batch.column("word").to_pylist(), np.stack(seen, axis=1).astype(float))
        piece, kind = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(piece), pa.array(total[piece, kind])], names=["kind", "piece", "uses"]
        )

    expected = words.where("c > 0").mapInArrow(expect, "kind int, piece long, uses double")
    found = expected.groupBy("kind", "piece").agg(F.sum("uses").alias("uses")).toArrow()  # subwords times kinds
    uses = np.zeros(lattice.scores.shape)
    uses[found.column("piece").to_numpy(), found.column("kind").to_numpy()] = found.column("uses").to_numpy()
    ends = np.array([size.distinct + 1.0 for size in sizes])
    total = uses.sum(axis=0) + SMOOTH * len(uses) + ends
    return Lattice(lattice.pieces, np.log((uses + SMOOTH) / total), np.log(ends / total))


def _weighed(words: DataFrame, lattice: Lattice, everything: Counts, sizes: list[Counts],
             end_share: float) -> DataFrame:
    """``word, c, s0, s1, ...``: log10 probability of every word in each kind, in whole units."""

    def weigh(batch: pa.RecordBatch, model: tuple) -> pa.RecordBatch:
        lattice, everything, sizes = model
        spelled_by = lattice.log_marginals(batch.column("word").to_pylist())
        kept = everything.kept(batch.column("c").to_numpy(zero_copy_only=False))
        scores = []
        with np.errstate(divide="ignore"):
            for k, size in enumerate(sizes):
                spelled = np.log(everything.freed()) + spelled_by[:, k]
                shared = np.log(size.freed()) + np.logaddexp(np.log(kept), spelled)
                own = np.log(size.kept(batch.column(f"c{k}").to_numpy(zero_copy_only=False)))
                log10 = (np.logaddexp(own, shared) + np.log1p(-end_share)) / np.log(10)
                scores.append(pa.array(np.round(log10 * UNITS).astype(np.int64)))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *scores],
                                          names=["word", "c", *(f"s{k}" for k in range(len(scores)))])

    columns = ", ".join(f"s{k} long" for k in range(len(sizes)))
    sent = send(words.sparkSession, (lattice, everything, sizes))
    return cut_lineage(map_batches(words, weigh, f"word binary, c long, {columns}", sent))


def _head_sums(rows: DataFrame, head: pa.Table, n_kinds: int) -> DataFrame:
    """Per document what the frequent words sum to, and its other words with their counts; written once."""
    index = {word: i for i, word in enumerate(head.column("word").to_pylist())}
    bases = np.log10(head.column("c").to_numpy() + 0.1)
    scores = np.stack([head.column(f"s{k}").to_numpy() for k in range(n_kinds)], axis=1)

    def look_up(batch: pa.RecordBatch, model: tuple) -> pa.RecordBatch:
        index, bases, scores = model
        ends, others, times = [0], [], []
        n_words, hits, base, sums = [], [], [], []
        for text in utf8(batch, "text"):
            counts = Counter(text.lower().split())
            at = [index.get(word, -1) for word in counts]
            others += [word for word, i in zip(counts, at) if i < 0]
            times += [n for n, i in zip(counts.values(), at) if i < 0]
            ends.append(len(others))
            at, n = np.array(at, np.int64), np.fromiter(counts.values(), np.int64, len(counts))
            n_words.append(int(n.sum()))
            n, at = n[at >= 0], at[at >= 0]
            hits.append(int(n.sum()))
            base.append(float(n @ bases[at]))
            sums.append((n @ scores[at]).tolist() if len(at) else [0] * scores.shape[1])
        rest = pa.StructArray.from_arrays([pa.array(others, pa.binary()), pa.array(times, pa.int64())],
                                          names=["word", "times"])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, hits)), pa.array(base, pa.float64()),
             pa.array(sums, pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)],
            names=["doc_id", "n_words", "hits", "base", "sums", "rest"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words long, hits long, base double, sums array<long>, "
              "rest array<struct<word: binary, times: long>>")
    found = map_batches(rows.select("doc_id", "text"), look_up, schema, send(rows.sparkSession, (index, bases, scores)))
    return cut_lineage(found.withColumn("row_no", F.monotonically_increasing_id()))


def score_texts(docs: DataFrame, vocabulary_path: str, modulus: int = 10, remainder: int = 0, text: str = "text",
                id_column: str = "doc_id", kind: str | None = "lang", head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents whose crc32 of the id leaves ``remainder`` are held out. Scores are
    log10 probabilities; ``base_score`` is that of add-0.1 word counts.
    """
    batches(docs.sparkSession)
    held_out = train_remainder(F.col("doc_id"), modulus) == remainder
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(text).alias("text"),
        (F.lit(None) if kind is None else F.col(kind)).cast("string").alias("kind"),
    ).withColumn("train", ~held_out)
    per_kind, rows = _kinds(rows)
    n_docs, n_kinds = sum(per_kind), len(per_kind)

    words = _word_counts(rows, n_kinds)
    everything, *sizes = Counts.of(words, ["c", *(f"c{k}" for k in range(n_kinds))])
    lattice = Lattice.of_ranks(vocabulary_path, n_kinds)
    for _ in range(rounds if everything.words else 0):
        lattice = _re_estimated(words, lattice, sizes)
    n = everything.words + n_docs
    denominator = n + 0.1 * (everything.distinct + (1 if n_docs else 0) + 1)
    end_share = (n_docs + 0.1) / denominator if n else 0.5

    weighed = _weighed(words, lattice, everything, sizes, end_share)
    top = weighed.where("c > 0").orderBy(F.col("c").desc(), "word").limit(head).toArrow()  # bounded by head
    parts = _head_sums(rows, top, n_kinds)
    tail = parts.select("row_no", F.explode("rest").alias("r")).select("row_no", "r.word", "r.times").join(weighed, "word")
    tail = tail.groupBy("row_no").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_hits"),
        F.sum(F.col("times") * F.log10(F.col("c") + 0.1)).alias("tail_base"),
        *(F.sum(F.col("times") * F.col(f"s{k}")).alias(f"tail{k}") for k in range(n_kinds)),
    )
    joined = parts.drop("rest").join(tail, "row_no", "left")
    shares = [float(np.log10((d + 1) / (n_docs + n_kinds))) for d in per_kind]
    each = [
        (F.get("sums", F.lit(k)) + F.coalesce(f"tail{k}", F.lit(0))) / UNITS + shares[k] for k in range(n_kinds)
    ]
    joined = joined.withColumns({f"each{k}": x for k, x in enumerate(each)})
    names = [F.col(f"each{k}") for k in range(n_kinds)]
    top_kind = F.greatest(*names) if n_kinds > 1 else names[0]
    over = sum((F.pow(F.lit(10.0), x - top_kind) for x in names[1:]), F.pow(F.lit(10.0), names[0] - top_kind))
    n_tokens = F.col("n_words") + 1
    return joined.select(
        "doc_id", held_out.alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("hits") + F.coalesce("tail_hits", F.lit(0)) + F.lit(1 if n_docs else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) + float(np.log10(n_docs + 0.1))
         - n_tokens * float(np.log10(denominator))).alias("base_score"),
        (top_kind + F.log10(over) + float(np.log10(end_share))).alias("score"),
    )
