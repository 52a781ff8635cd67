"""Many phrases in one pass over texts: an Aho-Corasick automaton as flat arrays.

Phrases are laid into a trie by their first ``ANCHOR`` bytes, level by level for
all phrases at once. ``goto`` is dense over the byte classes that occur, failure
links followed through, so a byte is one look-up. Texts lie one behind the other,
a separator between them, and are cut into segments that start ``ANCHOR`` bytes
early; all segments advance side by side, one byte per step. A longer phrase is
compared in full where its anchor was met.
"""

from __future__ import annotations

import numpy as np

ANCHOR = 12
WINDOW = 1 << 21  # bytes of text scanned at once
STEPS = 512  # bytes of a segment, where there is enough text


class Automaton:
    """Finds which of ``phrases`` (distinct, not empty) occur in texts."""

    def __init__(self, phrases: list[bytes], anchor: int = ANCHOR):
        self.phrases = phrases
        self.lead = min(anchor, max(map(len, phrases), default=1))
        used = np.unique(np.frombuffer(b"".join(p[: self.lead] for p in phrases), np.uint8))
        self.byte_class = np.full(256, 1, np.int32)  # 0 parts texts, 1 is any byte of no anchor
        self.byte_class[used] = np.arange(2, 2 + len(used))
        self.classes = 2 + len(used)
        self._lay(phrases)

    def _lay(self, phrases: list[bytes]) -> None:
        length = np.fromiter((min(len(p), self.lead) for p in phrases), np.int64, len(phrases))
        letters = np.frombuffer(b"".join(p[: self.lead].ljust(self.lead, b"\0") for p in phrases), np.uint8)
        kinds = self.byte_class[letters.reshape(len(phrases), self.lead)]
        node = np.zeros(len(phrases), np.int64)  # where each phrase has got to
        levels: list[tuple[np.ndarray, np.ndarray]] = []  # parents and classes of the nodes of a depth
        first = [0, 1]  # the first node of each depth
        for depth in range(self.lead):
            on = np.flatnonzero(length > depth)
            edges, place = np.unique(node[on] * self.classes + kinds[on, depth], return_inverse=True)
            node[on] = first[-1] + place
            levels.append(np.divmod(edges, self.classes))
            first.append(first[-1] + len(edges))
        n = first[-1]
        goto = np.zeros((n, self.classes), np.int32)
        fail = np.zeros(n, np.int64)
        for depth, (parents, kind) in enumerate(levels):
            children = np.arange(first[depth + 1], first[depth + 2])
            own = np.arange(first[depth], first[depth + 1])
            if depth:
                goto[own] = goto[fail[own]]
                fail[children] = goto[fail[parents], kind]
            goto[parents, kind] = children
        last = np.arange(first[-2], n)
        if self.lead and len(last):
            goto[last] = goto[fail[last]]
        goto[:, 0] = 0
        # phrases that end at a node, and the next node behind it at which some end
        order = np.argsort(node, kind="stable")
        ends = np.bincount(node, minlength=n)
        self.ending, self.end_first, self.end_count = order, np.cumsum(ends) - ends, ends
        self.onward = np.zeros(n, np.int64)
        for depth in range(1, len(first) - 1):
            own = np.arange(first[depth], first[depth + 1])
            back = fail[own]
            self.onward[own] = np.where(ends[back] > 0, back, self.onward[back])
        self.hit = (ends > 0) | (self.onward > 0)
        self.goto = (goto * self.classes).ravel()  # of premultiplied nodes

    def _met(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last byte, node) wherever an anchor ends."""
        steps = min(STEPS, max(64, len(kinds) // 1024))
        rows, early = -(-len(kinds) // steps), self.lead - 1
        laid = np.zeros(early + rows * steps, np.int32)
        laid[early : early + len(kinds)] = kinds
        side = laid.strides[0]
        grid = np.lib.stride_tricks.as_strided(laid, (early + steps, rows), (side, steps * side))
        state, ends, nodes = np.zeros(rows, np.int32), [], []
        for step in range(early + steps):
            state = self.goto[state + grid[step]]
            if step >= early:
                at = np.flatnonzero(state)
                if len(at):
                    found = state[at] // self.classes
                    good = self.hit[found]
                    ends.append(at[good] * steps + step - early)
                    nodes.append(found[good])
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(ends), np.concatenate(nodes)

    def find(self, texts: list[bytes]) -> list[list[int]]:
        """The phrases in each text, by number and without repeats."""
        out: list[set[int]] = [set() for _ in texts]
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        border = np.cumsum(length + 1) - 1  # the separator behind each text
        buffer = b"\0".join([*texts, b""])
        raw = np.frombuffer(buffer, np.uint8)
        for low in range(0, len(raw), WINDOW):
            begin = max(0, low - self.lead + 1)
            kinds = self.byte_class[raw[begin : low + WINDOW]]
            here = border[np.searchsorted(border, begin) : np.searchsorted(border, low + WINDOW)]
            kinds[here - begin] = 0
            end, node = self._met(kinds)
            end += begin
            while len(end):
                self._note(buffer, border, end, node, out)
                node = self.onward[node]
                end, node = end[node > 0], node[node > 0]
        return [sorted(found) for found in out]

    def _note(self, buffer: bytes, border: np.ndarray, end: np.ndarray, node: np.ndarray, out: list[set[int]]) -> None:
        """Notes the phrases whose anchors end at these nodes."""
        count = self.end_count[node]
        text = np.repeat(np.searchsorted(border, end), count)
        size = count.sum()
        phrase = self.ending[np.repeat(self.end_first[node] - (np.cumsum(count) - count), count) + np.arange(size)]
        stop = np.repeat(end, count)
        _, one = np.unique(text * len(self.phrases) + phrase, return_index=True)
        whole = np.fromiter((len(self.phrases[p]) <= self.lead for p in phrase[one]), bool, len(one))
        for t, p in zip(text[one[whole]].tolist(), phrase[one[whole]].tolist()):
            out[t].add(p)
        if whole.all():
            return
        partly = {int(p) for p in phrase[one[~whole]]}
        for t, p, e in zip(text.tolist(), phrase.tolist(), stop.tolist()):
            if p in partly and p not in out[t]:
                start = e + 1 - self.lead
                if start + len(self.phrases[p]) <= border[t] and buffer.startswith(self.phrases[p], start):
                    out[t].add(p)
