"""FM-index over a sequence of small integers in numpy: wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions in the order of their suffixes.

    Each 0 counts as a symbol of its own, smaller than all others and smaller than every 0
    after it, so a comparison ends there. Several symbols are packed into the first key;
    then ranks of doubled length settle what is still equal.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    width = 63 // bits
    padded = np.append(symbols.astype(np.int64), np.zeros(width, np.int64))
    key = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for k in range(width):
        part = padded[k : k + n]
        ended |= part == 0
        key = (key << bits) | np.where(ended, 0, part)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    starts = np.append(True, ordered[1:] != ordered[:-1]) if n else np.zeros(0, bool)
    # Equal keys that hold a 0 are in order already, since the earlier 0 is the smaller one.
    starts |= ended[order]
    head = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order] = head
    rank[n] = -1
    tied = np.flatnonzero(~starts | np.append(~starts[1:], False)) if n else np.zeros(0, np.int64)
    step = width
    while len(tied):
        at = order[tied]
        pair = rank[at] * (n + 1) + rank[np.minimum(at + step, n)] + 1
        again = np.argsort(pair, kind="stable")
        order[tied] = at[again]
        pair = pair[again]
        new = np.append(True, pair[1:] != pair[:-1])
        rank[order[tied]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        tied = tied[~new | np.append(~new[1:], False)]
        step *= 2
    return order


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self._words = np.append(packed, np.zeros(8 - len(packed) % 8, np.uint8)).view(np.uint64)
        counts = np.bitwise_count(self._words).astype(np.int64)
        self._before = np.cumsum(counts) - counts
        self.zeros = len(bits) - int(counts.sum())

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & mask)

    def at(self, at: np.ndarray) -> np.ndarray:
        return (self._words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class FMIndex:
    """Counts and places of phrases in a sequence whose 0s separate searchable runs."""

    SAMPLE = 8

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = suffix_order(symbols)
        self.size = n
        top = int(symbols.max(initial=0))
        self.first = np.append(0, np.cumsum(np.bincount(symbols, minlength=top + 1)))
        self.before = np.where(order > 0, symbols[order - 1], 0) if n else symbols
        self._levels = []
        self._height = max(1, top.bit_length())
        current = self.before
        for level in reversed(range(self._height)):
            bit = (current >> level & 1).astype(bool)
            self._levels.append(Bits(bit))
            current = np.concatenate([current[~bit], current[bit]])
        # Positions are kept at every eighth place and wherever a separator stands before.
        kept = (order % self.SAMPLE == 0) | (self.before == 0)
        self._kept = Bits(kept)
        self._positions = order[kept]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first ``row`` entries of the transform."""
        low = np.zeros(len(row), np.int64)
        for level, bits in zip(reversed(range(self._height)), self._levels):
            one = (symbol >> level & 1).astype(bool)
            ones_low, ones_row = bits.ones_before(low), bits.ones_before(row)
            low = np.where(one, bits.zeros + ones_low, low - ones_low)
            row = np.where(one, bits.zeros + ones_row, row - ones_row)
        return row - low

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of each phrase, by backward search.

        ``phrases`` holds one phrase a row, filled up at the end; symbols beyond the
        index's alphabet occur nowhere.
        """
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size, np.int64)
        top = len(self.first) - 2
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            symbol = phrases[live, lengths[live] - back].astype(np.int64)
            known = (symbol <= top) & (symbol > 0)
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            if back == 1:
                low[live], high[live] = self.first[symbol], self.first[symbol + 1]
            else:
                low[live] = self.first[symbol] + self.rank(symbol, low[live])
                high[live] = self.first[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: step back until a kept position is met."""
        out = np.zeros(len(rows), np.int64)
        open_, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            kept = self._kept.at(row).astype(bool)
            out[open_[kept]] = self._positions[self._kept.ones_before(row[kept])] + steps
            open_, row = open_[~kept], row[~kept]
            symbol = self.before[row].astype(np.int64)
            row = self.first[symbol] + self.rank(symbol, row)
            steps += 1
        return out
