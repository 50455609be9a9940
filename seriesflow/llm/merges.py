"""Merges of neighbouring symbols by rank, for many words at a time."""

from __future__ import annotations

import numpy as np

from seriesflow.llm.common import starts_of

NONE = np.int32(2**31 - 1)


class Pairs:
    """Sorted table of mergeable pairs: rank and merged symbol of each."""

    def __init__(self, left, right, rank, merged, symbols: int):
        key = np.asarray(left, np.int64) * symbols + np.asarray(right, np.int64)
        order = np.argsort(key)
        self.symbols = symbols
        self.key = key[order]
        self.rank = np.asarray(rank, np.int32)[order]
        self.merged = np.asarray(merged, np.int32)[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without a merge) and merged symbol; symbols below 0 never merge."""
        if not len(self.key):
            return np.full(len(left), NONE), np.zeros(len(left), np.int32)
        key = left.astype(np.int64) * self.symbols + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NONE), self.merged[at]


def merge_words(symbols: np.ndarray, lengths: np.ndarray, pairs: Pairs):
    """Symbols and lengths of the words (none empty) after all merges.

    Same result as merging, in each word by itself, the pair of lowest rank, the
    leftmost of equals, until no pair is left. A round takes the lowest rank of each
    word and merges all its places from left to right at once, up to the first place
    whose merge makes a pair of the same or a lower rank beside it: what lies further
    right has to wait for that pair. Words without a pair leave the arrays, merged
    symbols are closed up, and only pairs beside a merge are looked up again.
    """
    count = len(lengths)
    symbols, lengths = symbols.astype(np.int32), lengths.astype(np.int64)
    word = np.arange(count)
    done_symbols, done_words, done_lengths = [], [], []
    rank, merged = _ranks(symbols, lengths, pairs)
    while len(lengths):
        starts = starts_of(lengths)
        lowest = np.minimum.reduceat(rank, starts)
        ready = lowest == NONE
        if ready.any():
            out = np.repeat(ready, lengths)
            done_symbols.append(symbols[out])
            done_words.append(word[ready])
            done_lengths.append(lengths[ready])
            symbols, rank, merged = symbols[~out], rank[~out], merged[~out]
            word, lengths, lowest = word[~ready], lengths[~ready], lowest[~ready]
            if not len(lengths):
                break
            starts = starts_of(lengths)
        at = np.flatnonzero(rank == np.repeat(lowest, lengths))
        at = at[_alternate(at)]
        at = _in_order(at, symbols, merged, rank, starts, pairs)
        symbols[at] = merged[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        # the pair of a merged symbol and what follows is that of the removed symbol
        ends = np.zeros(len(symbols), bool)
        ends[starts + lengths - 1] = True
        ends[at] = ends[at + 1]
        new = np.cumsum(keep) - 1
        lengths = np.add.reduceat(keep, starts, dtype=np.int64)
        symbols, ends, rank, merged = symbols[keep], ends[keep], rank[keep], merged[keep]
        moved = new[at]
        starts_now = starts_of(lengths)
        first = np.zeros(len(symbols), bool)
        first[starts_now] = True
        beside = np.zeros(len(symbols), bool)
        beside[moved] = True
        beside[moved[~first[moved]] - 1] = True
        rank[beside] = NONE
        touched = np.flatnonzero(beside & ~ends)
        rank[touched], merged[touched] = pairs.find(symbols[touched], symbols[touched + 1])
    if not done_words:
        return symbols, lengths
    words, sizes = np.concatenate(done_words), np.concatenate(done_lengths)
    flat = np.concatenate(done_symbols)
    order = np.argsort(words)
    begins = starts_of(sizes)[order]
    sizes = sizes[order]
    index = np.repeat(begins - starts_of(sizes), sizes) + np.arange(len(flat))
    return flat[index], sizes


def _ranks(symbols, lengths, pairs):
    rank = np.full(len(symbols), NONE)
    merged = np.zeros(len(symbols), np.int32)
    if len(symbols) > 1:
        rank[:-1], merged[:-1] = pairs.find(symbols[:-1], symbols[1:])
    if len(lengths):
        rank[np.cumsum(lengths) - 1] = NONE
    return rank, merged


def _alternate(at: np.ndarray) -> np.ndarray:
    """Every other place of each run of neighbours, the first included."""
    run_start = np.ones(len(at), bool)
    run_start[1:] = np.diff(at) != 1
    first = np.maximum.accumulate(np.where(run_start, np.arange(len(at)), 0))
    return (np.arange(len(at)) - first) % 2 == 0


def _in_order(at, symbols, merged, rank, starts, pairs):
    """The places that may be merged together; all but the first are put off at times."""
    made = merged[at]
    word = np.searchsorted(starts, at, "right") - 1
    begin = starts[word]
    end = np.append(starts[1:], len(symbols))[word]
    before = symbols[np.maximum(at - 1, 0)].copy()
    follows = np.zeros(len(at), bool)
    follows[1:] = at[1:] == at[:-1] + 2
    before[1:] = np.where(follows[1:], made[:-1], before[1:])
    before = np.where(at > begin, before, -1)
    after = np.where(at + 2 < end, symbols[np.minimum(at + 2, len(symbols) - 1)], -1)
    sooner = np.minimum(pairs.find(before, made)[0], pairs.find(made, after)[0]) <= rank[at]
    if not sooner.any():
        return at
    total = np.cumsum(sooner) - sooner
    first = np.ones(len(at), bool)
    first[1:] = word[1:] != word[:-1]
    base = np.maximum.accumulate(np.where(first, total, 0))
    return at[total == base]
