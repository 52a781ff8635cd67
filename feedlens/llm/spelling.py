"""Spelling variants of frequent words, by a trie over letter-group counts.

A word's frequency vector holds its length and how many of its letters fall into
each group of ``LETTER_GROUPS``. One inserted letter adds one to one count, one
replaced letter adds one somewhere and takes one elsewhere (or leaves the vector
as it is). So all words near a word are found by walking a trie whose levels are
the counts, depth first, with a budget of one surplus and one deficit. Each pair
is looked for from one side only, the shorter word's or that whose vector comes
first: a surplus must come before the deficit. The walk carries the words that
are looked for as arrays, split at each node by the budget they have left; words
that meet at a leaf are verified letter by letter.

How it scales: words are counted in the tasks and by one exchange. The trie is
cut at a level that is chosen from the counts, so that no subtree (``shard``)
holds more than ``SHARD`` words; a word goes to its own shard as an entry, and to
the few that the budget can reach as a search. A shard that cannot be cut further
is split by hash, and searched in all its parts. Of the pairs found, a shard
returns one row per word: how many, and the best. Forms are followed by pointer
doubling, whose steps are bounded by the factor of ten between a word and its
form. Nothing but a few counts reaches the driver.

Rows, one by one: a null text has no words; a null id counts as empty text in the
checksum; texts are read whole and words may be of any length; repeated rows and
ids count each for itself; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import LOWER, UPPER, batches, utf8
from feedlens.session import cut_lineage

MIN_LENGTH = 7
MIN_COUNT = 2
FACTOR = 10
NOISE = 31
HELD_WORDS = 200_000  # distinct words that a task counts before it hands them on
SHARD = 1 << 14  # words of one subtree
DEEPEST = 8  # levels, besides the length, at which the trie may be cut
LEAF = 24  # words of a node that is not split further
PAIRS = 1 << 18  # pairs that are verified at once

#: one level each, the common letters alone; all other letters by their code point into four more
LETTER_GROUPS = ("e", "n", "a", "t", "o", "i", "h", "r", "s", "u", "l", "c", "d", "fby", "gwp", "mvk", "zqxj")
REST_GROUPS = 4
LEVELS = len(LETTER_GROUPS) + REST_GROUPS
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


# --- words -------------------------------------------------------------------


def noisy(doc_id: str, word: str, noise: int = NOISE) -> str:
    """``word`` as its document has it: a letter short where ``noise`` divides the checksum."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % noise:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, text: str = "text", id_column: str = "doc_id", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """``word, n``: the words of at least ``min_length`` letters that occur ``min_count`` times."""
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_length).findall
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )
            counts.clear()
            return made

        for batch in stream:
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch, "text")):
                for word, n in Counter(find(raw.translate(_ASCII_LOWER).decode("utf-8", "replace"))).items():
                    word = noisy(doc_id, word, noise)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield out()
        if counts:
            yield out()

    counted = rows.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- vectors and shards ----------------------------------------------------------


def _group_of() -> np.ndarray:
    """The group of each code point up to 255."""
    group = np.array([len(LETTER_GROUPS) + c % REST_GROUPS for c in range(256)], np.uint8)
    for i, letters in enumerate(LETTER_GROUPS):
        for letter in letters:
            group[ord(letter)] = i
    return group


class Words:
    """Words as arrays: their letters, filled up with zeros, and their vectors."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]
        self.length = np.fromiter(map(len, raw), np.int64, len(raw))
        self.width = int(self.length.max(initial=0))
        self.letters = np.frombuffer(b"".join(w.ljust(self.width, b"\0") for w in raw), np.uint8).reshape(len(raw), self.width)
        group = _group_of()
        group[0] = LEVELS  # fills up
        self.counts = np.zeros((len(raw), LEVELS), np.int32)
        rows = np.arange(len(raw))
        for i in range(self.width):
            of = group[self.letters[:, i]]
            on = of < LEVELS
            np.add.at(self.counts, (rows[on], of[on]), 1)


def _weights() -> np.ndarray:
    """A shard is named by the weighted sum of length and counts, modulo 2**64."""
    return np.random.default_rng(12).integers(1 << 62, 1 << 63, LEVELS + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def shard_keys(words: Words, depth: int) -> np.ndarray:
    weight = _weights()
    key = words.length.astype(np.uint64) * weight[-1]
    for i in range(depth):
        key = key + words.counts[:, i].astype(np.uint64) * weight[i]
    return key


def searched(words: Words, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, shards) that the budget reaches from a word's own shard, its own aside."""
    weight, own, everyone = _weights(), shard_keys(words, depth), np.arange(len(words.length))
    yield everyone, own + weight[-1]  # one letter more, of a group behind the cut
    for i in range(depth):
        yield everyone, own + weight[-1] + weight[i]  # one letter more, of this group
        yield everyone, own + weight[i]  # one letter replaced: the deficit lies behind the cut
        for j in range(i + 1, depth):
            some = np.flatnonzero(words.counts[:, j])
            yield some, own[some] + weight[i] - weight[j]


def _route(depth: int, parts: int):
    """Rows of words to rows of shards: each word as an entry of one, and as a search of some."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            words = Words(batch.column("word").to_pylist())
            every = np.arange(batch.num_rows)
            home = np.array([zlib.crc32(w.tobytes()) % parts for w in words.letters], np.int64)
            moves = [(every, shard_keys(words, depth), home, True)]
            for part in range(parts):
                for rows, keys in searched(words, depth):
                    moves.append((rows, keys, np.full(len(rows), part), False))
                if parts > 1:  # the other parts of its own shard
                    rows = every[home != part]
                    moves.append((rows, moves[0][1][rows], np.full(len(rows), part), False))
            for rows, keys, part, entry in moves:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(part, pa.int32()), pa.array(np.full(len(rows), entry)),
                     batch.column("word").take(pa.array(rows)), batch.column("n").take(pa.array(rows))],
                    names=["shard", "part", "entry", "word", "n"],
                )

    return run


def _deep_enough(words: DataFrame, most: int) -> tuple[int, int]:
    """The level at which the trie is cut, and the parts of a shard: no part holds more than about ``most`` words."""
    largest = 0
    for depth in range(1, DEEPEST + 1):

        def run(stream: Iterator[pa.RecordBatch], depth: int = depth) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                keys, n = np.unique(shard_keys(Words(batch.column("word").to_pylist()), depth), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["shard", "n"])

        sizes = words.select("word").mapInArrow(run, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
        largest = sizes.agg(F.max("n")).first()[0] or 0
        if largest <= most:
            return depth, 1
    return DEEPEST, -(-largest // most)


# --- the trie --------------------------------------------------------------------


class Trie:
    """Entries in the order of their vectors: a node is a stretch of them, split by the count of its level."""

    def __init__(self, words: Words, entries: np.ndarray):
        self.order = entries[np.lexsort(words.counts[entries].T[::-1])]
        self.words = words
        self.sorted = words.counts[self.order]
        wide = words.width
        ends = np.zeros((len(words.length), 6), np.uint8)
        ends[:, : min(3, wide)] = words.letters[:, : min(3, wide)]
        for k in range(3):
            at = words.length - 1 - k
            ends[:, 3 + k] = np.where(at >= 0, words.letters[np.arange(len(at)), np.maximum(at, 0)], 0) if wide else 0
        number = ends.astype(np.int64)
        self.head = number[:, 0] << 16 | number[:, 1] << 8 | number[:, 2]
        self.tail = number[:, 3] << 16 | number[:, 4] << 8 | number[:, 5]

    def meetings(self, searches: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(searched words, entries) that share a leaf and an untouched first or last three letters.

        One edit of a word of seven letters leaves one of its two ends as it was;
        shorter words are not told apart here.
        """
        counts, short = self.words.counts, self.words.length < 7
        stack = [(0, len(self.order), 0, searches, np.zeros(len(searches), np.int8))]
        while stack:
            low, high, level, rows, spent = stack.pop()
            if high - low <= LEAF or level == LEVELS:
                for a in range(0, len(rows), 1 << 12):
                    for b in range(low, high, 1 << 10):
                        some, here = rows[a : a + (1 << 12), None], self.order[None, b : min(b + (1 << 10), high)]
                        near = (self.head[some] == self.head[here]) | (self.tail[some] == self.tail[here]) | (short[some] & short[here])
                        i, j = np.nonzero(near)
                        yield some[i, 0], here[0, j]
                continue
            column = self.sorted[low:high, level]
            border = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [high - low]])
            have = counts[rows, level]
            for first, last in zip(border.tolist(), border[1:].tolist()):
                more = column[first] - have
                able = (more == 0) | ((more == 1) & (spent == 0)) | ((more == -1) & (spent == 1))
                if able.any():
                    stack.append((low + first, low + last, level + 1, rows[able], spent[able] + np.abs(more[able]).astype(np.int8)))

    def near(self, searches: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs one edit apart, each from one side."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        most = max(1, min(PAIRS, (1 << 25) // (self.words.width + 1)))
        for pair in self.meetings(searches):
            held.append(pair)
            n += len(pair[0])
            if n >= most:
                yield from self._verified(held, most)
                held, n = [], 0
        if held:
            yield from self._verified(held, most)

    def _verified(self, held: list[tuple[np.ndarray, np.ndarray]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left, right = (np.concatenate(side) for side in zip(*held))
        for low in range(0, len(left), most):
            a, b = left[low : low + most], right[low : low + most]
            length = self.words.length
            for gap, test in ((0, self._replaced), (1, self._inserted)):
                on = length[b] - length[a] == gap
                kept = test(a[on], b[on])
                yield a[on][kept], b[on][kept]

    def _replaced(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One letter differs, and ``b`` is the later of the two."""
        differ = self.words.letters[a] != self.words.letters[b]
        one = differ.sum(axis=1) == 1
        at = differ.argmax(axis=1) if self.words.width else np.zeros(len(a), np.int64)
        x, y = self.words.letters[a, at], self.words.letters[b, at]
        group = _group_of().astype(np.int64)
        # a surplus of an earlier level comes first; within a level, the later letter
        later = np.where(group[x] == group[y], y > x, group[y] < group[x])
        return one & later

    def _inserted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``b`` is ``a`` with one letter more."""
        x, y, wide = self.words.letters[a], self.words.letters[b], self.words.width
        same = np.zeros((len(a), wide), bool)
        same[:, : wide - 1] = x[:, : wide - 1] == y[:, : wide - 1]
        first = same.argmin(axis=1)  # of unequal letters; the last column is False
        column = np.arange(wide - 1)[None, :]
        return ((x[:, : wide - 1] == y[:, 1:]) | (column < first[:, None])).all(axis=1)


def near_words(shard: pa.Table) -> pa.Table:
    """``word, n_near, best``: of the words of a shard, those with near ones, their number and the best."""
    rows = shard.group_by("word").aggregate([("n", "max"), ("entry", "max")])
    names = rows.column("word").to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    names = [names[i] for i in order]
    count = rows.column("n_max").to_numpy()[order].astype(np.int64)
    entry = rows.column("entry_max").to_numpy(zero_copy_only=False)[order].astype(bool)
    words = Words(names)
    found = list(Trie(words, np.flatnonzero(entry)).near(np.arange(len(names)))) if entry.any() else []
    one, two = (np.concatenate([*side]) for side in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    word, other = np.concatenate([one, two]), np.concatenate([two, one])
    by = np.lexsort([other, -count[other], word])
    word, other = word[by], other[by]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    best = other[first]
    return pa.table({
        "word": pa.array([names[i] for i in word[first].tolist()], pa.string()),
        "n_near": pa.array(np.diff(np.append(first, len(word))), pa.int64()),
        "best_n": pa.array(count[best], pa.int64()),
        "best": pa.array([names[i] for i in best.tolist()], pa.string()),
    })


# --- forms and roots ---------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: pointers doubled until none moves."""
    links = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        moved = cut_lineage(links.join(onward, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("_moved")
        ))
        links = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return links


def variants(words: DataFrame, factor: int = FACTOR, most: int = SHARD) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every row ``word, n``; words are distinct, of code points up to 255.

    Two words are near if one inserted, deleted or replaced letter makes one the
    other. A word's form is the near word with the largest ``n`` (of equals the
    smallest), if that is at least ``factor`` times its own.
    """
    words = cut_lineage(words.select("word", "n"))
    depth, parts = _deep_enough(words, most)
    routed = words.mapInArrow(_route(depth, parts), "shard long, part int, entry boolean, word string, n long")
    near = routed.groupBy("shard", "part").applyInArrow(near_words, "word string, n_near long, best_n long, best string")
    summed = near.groupBy(F.col("word").alias("_word")).agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("_best")
    )
    large = -F.col("_best.n") >= factor * F.col("n")
    judged = cut_lineage(words.join(summed, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(large, F.col("_best.word")).alias("form"), F.when(large, -F.col("_best.n")).alias("form_n"),
    ))
    roots = _roots(judged.where(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    return judged.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def group_variants(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The words of all texts with their near words, forms and roots."""
    batches(docs.sparkSession)
    return variants(count_words(docs, text, id_column))


ORACLE_SQL = """
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
run_rows AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{7,}')) AS w
  FROM documents),
runs AS (SELECT id, w, count(*) AS n FROM run_rows GROUP BY id, w),
coded AS (
  SELECT w, n, flatten(list_transform(string_split(id || ':' || w, ''),
         lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS bytes FROM runs),
hashed AS (
  SELECT w, n, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bytes),
         lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM coded, table_of),
made AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM places),
near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.d = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.d = w.word),
ranked AS (
  SELECT near.word, near.other, o.n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, near.other) AS place
  FROM near JOIN words o ON o.word = near.other),
judged AS (
  SELECT words.word, words.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.n >= 10 * words.n THEN r.other END AS form, CASE WHEN r.n >= 10 * words.n THEN r.n END AS form_n
  FROM words LEFT JOIN ranked r ON r.word = words.word AND r.place = 1),
walk AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT walk.word, judged.word, judged.form FROM walk JOIN judged ON judged.word = walk.next)
SELECT j.word, j.n, j.n_near, j.form, j.form_n, walk.root FROM judged j JOIN walk ON walk.word = j.word AND walk.next IS NULL
"""
