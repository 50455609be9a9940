"""Bidirectional FM-index over a delimited vocabulary, searched for whole batches at once.

The text is every word followed by a delimiter, read as a ring. One array of sorted
rotations each serves the text and its reverse. A string is kept as the range of rotations
that begin with it in both; adding a symbol on either side narrows both ranges. Ranges of
many queries are numpy arrays that take each step together.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 15  # states that take a step together


class Ring:
    """Sorted rotations of a ring of symbols: the symbols before them, and counts of these."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        self.order = rotations(text)
        before = text[self.order - 1]
        self.step = max(64, symbols)
        pad = -n % self.step + self.step
        self.before = np.append(before, np.full(pad, 255 if symbols < 255 else symbols)).astype(
            np.uint8 if symbols < 255 else np.int32)
        rows = (n + pad) // self.step
        counts = np.bincount(np.arange(n) // self.step * symbols + before, minlength=rows * symbols)
        self.counts = np.zeros((rows, symbols), np.int32)
        np.cumsum(counts.reshape(rows, symbols)[:-1], axis=0, out=self.counts[1:])
        self.first = np.append(0, np.cumsum(np.bincount(text, minlength=symbols)))[:-1]
        self.symbols, self.width = symbols, np.arange(self.step)

    def _tails(self, at: np.ndarray):
        row = at // self.step
        near = self.before[(row * self.step)[:, None] + self.width]
        return row, near, self.width < (at - row * self.step)[:, None]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol precedes one of the rotations before ``at``."""
        row, near, inside = self._tails(at)
        return self.counts[row, symbol] + ((near == symbol[:, None]) & inside).sum(axis=1)

    def ranks(self, at: np.ndarray) -> np.ndarray:
        """The same for all symbols: a row for each place."""
        row, near, inside = self._tails(at)
        line = np.broadcast_to(np.arange(len(at))[:, None] * self.symbols, near.shape)[inside]
        tails = np.bincount(line + near[inside], minlength=len(at) * self.symbols)
        return self.counts[row] + tails.reshape(len(at), self.symbols)


def rotations(text: np.ndarray) -> np.ndarray:
    """Starts of all rotations in order, by prefix doubling. They must all differ."""
    _, rank = np.unique(text, return_inverse=True)
    n, width = len(text), 1
    while True:
        key = rank * n + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.append(0, np.cumsum(np.diff(key[order]) != 0))
        width *= 2
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        if width > 2 * n:
            raise ValueError("the words of an index must be different")


class Vocabulary:
    """Index over different words without zero characters."""

    def __init__(self, words: list[str]):
        points = _points("".join(w + "\0" for w in words))
        self.alphabet = np.unique(points)
        text = np.searchsorted(self.alphabet, points)
        self.forward, self.reverse = Ring(text, len(self.alphabet)), Ring(text[::-1], len(self.alphabet))
        ends = np.cumsum(points == 0)  # the delimiter after word k is number k + 1
        self.after = ends % max(len(words), 1)  # word that begins after a delimiter
        self.until = (ends - 1)[::-1]  # word that ends at a delimiter, by places of the reverse

    def symbols(self, words: list[str]):
        """Rows of symbols (-1 where the index has none), and lengths."""
        lengths = np.array([len(w) for w in words], np.int64)
        points = _points("".join(words))
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        rows = np.zeros((len(words), int(lengths.max(initial=0)) + 1), np.int64)
        inside = np.arange(rows.shape[1]) < lengths[:, None]
        rows[inside] = np.where(self.alphabet[at] == points, at, -1)
        return rows, lengths

    def one_error(self, words: list[str], left_exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word of the index) exactly one edit apart.

        The search begins in the middle of a query and matches one half outwards to the
        delimiter without error, the left half if ``left_exact``; then it turns round and
        matches the other half with one code point inserted, deleted or replaced.
        """
        mirrored = words if left_exact else [w[::-1] for w in words]
        rows, lengths = self.symbols(mirrored)
        halves = lengths // 2 if left_exact else lengths - lengths // 2
        near, far = (self.forward, self.reverse) if left_exact else (self.reverse, self.forward)
        found = [self._search(near, far, rows[a:a + CHUNK], lengths[a:a + CHUNK], halves[a:a + CHUNK], a)
                 for a in range(0, len(words), CHUNK)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        queries, places = (np.concatenate(x) for x in zip(*found))
        of = self.until if left_exact else self.after
        pairs = np.unique(np.stack([queries, of[far.order[places]]]), axis=1)
        return pairs[0], pairs[1]

    def _search(self, near: Ring, far: Ring, rows, lengths, halves, base):
        size_all = len(near.order)
        query = np.arange(len(rows))
        low, other, size = (np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64),
                            np.full(len(rows), size_all))
        # outwards without error: symbols before the middle, then the delimiter
        for step in range(int(halves.max(initial=0)) + 1):
            here = np.flatnonzero(step <= halves[query])
            place = halves[query[here]] - 1 - step
            symbol = np.where(place >= 0, rows[query[here], place], 0)
            counts = near.ranks(low[here])
            more = near.ranks(low[here] + size[here]) - counts
            fits = symbol >= 0
            symbol = np.maximum(symbol, 0)
            line = np.arange(len(here))
            width = np.where(fits, more[line, symbol], 0)
            less = np.cumsum(more, axis=1)[line, symbol] - more[line, symbol]
            low[here] = near.first[symbol] + counts[line, symbol]
            other[here] += less
            size[here] = width
            alive = size > 0
            query, low, other, size = query[alive], low[alive], other[alive], size[alive]
        found = []
        low, at = other, halves[query]
        while len(query):  # the way without an error so far; at each place one may come in
            counts = far.ranks(low)
            more = far.ranks(low + size) - counts
            begin = counts + far.first
            at_end = at >= lengths[query]
            symbol = np.where(at_end, 0, rows[query, at])
            line, extra = np.nonzero(more[:, 1:])
            extra += 1
            into = (query[line], begin[line, extra], more[line, extra])
            replaced = ~at_end[line] & (extra != symbol[line])
            gone = np.flatnonzero(~at_end)
            starts = [
                (*into, at[line]),  # the index has one more
                tuple(x[replaced] for x in (*into, at[line] + 1)),
                (query[gone], low[gone], size[gone], at[gone] + 1),  # the index has one less
            ]
            states = [np.concatenate(x) for x in zip(*starts)]
            for a in range(0, len(states[0]), CHUNK):
                found.append(self._finish(far, rows, lengths, *[x[a:a + CHUNK] for x in states]))
            line = np.arange(len(query))
            width = np.where(symbol >= 0, more[line, np.maximum(symbol, 0)], 0)
            alive = ~at_end & (width > 0)
            low = begin[line, np.maximum(symbol, 0)][alive]
            query, size, at = query[alive], width[alive], at[alive] + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        queries, places = (np.concatenate(x) for x in zip(*found))
        return queries + base, places

    @staticmethod
    def _finish(ring: Ring, rows, lengths, query, low, size, at):
        """Queries and places of those states that match to the delimiter without a further error."""
        done = []
        while len(query):
            ends = at >= lengths[query]
            symbol = np.where(ends, 0, rows[query, np.minimum(at, rows.shape[1] - 1)])
            fits = symbol >= 0
            query, low, size, at, ends, symbol = (x[fits] for x in (query, low, size, at, ends, symbol))
            begin = ring.rank(symbol, low)
            size = ring.rank(symbol, low + size) - begin
            low = ring.first[symbol] + begin
            alive = size > 0
            hit = alive & ends
            done.append((query[hit], low[hit]))
            go = alive & ~ends
            query, low, size, at = query[go], low[go], size[go], at[go] + 1
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 2


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
