"""Repeated strings of a byte sequence by external induced suffix sorting.

Suffixes are put in order by induction: the leftmost S-type suffixes (those whose left
neighbour is larger) are sorted first, the L-type suffixes follow from them in one ascending
sweep, and all S-type suffixes from these in one descending sweep. The sweeps take suffixes
from queues ordered by first symbol and, within one, by arrival; whole runs of the queue are
handled at a time in numpy. Each entry carries its common prefix with the entry before, and
a range minimum over the sweep gives that of the entries it induces. Queues hold a bounded
part in memory and the rest in an unnamed file of the task; the sequence itself is a memory
map.

The starting suffixes are sorted by the same sweeps over their substrings, which names them;
where names repeat, the sequence of names is ranked by comparing several ranks at a time, until
equal strings are as long as what is asked for.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

#: Entries that all queues of a sort hold in memory.
HELD = 4_000_000
#: Entries of one run that are handled at a time.
RUN = 1 << 16
SYMBOLS = 258


class Queues:
    """One first-in first-out queue of (place, common prefix) per symbol, spilled to disk."""

    def __init__(self, held: int = HELD):
        self._parts: list[list] = [[] for _ in range(SYMBOLS)]
        self._limit, self._held = held, 0
        self._file = None
        self._end = 0

    def push(self, symbol: int, entries: np.ndarray) -> None:
        """Append entries, an array of two rows."""
        self._parts[symbol].append(entries)
        self._held += entries.shape[1]
        if self._held > self._limit:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        self._file.seek(self._end)
        for parts in self._parts:
            fresh = [p for p in parts if isinstance(p, np.ndarray)]
            if not fresh:
                continue
            joined = np.concatenate(fresh, axis=1)
            # Written parts always come before fresh ones of the same queue.
            parts[:] = [p for p in parts if not isinstance(p, np.ndarray)]
            parts.append((self._end, joined.shape))
            self._file.write(joined.astype(np.int64).tobytes())
            self._end += joined.size * 8
        self._held = 0

    def _read(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part
        at, shape = part
        self._file.seek(at)
        return np.frombuffer(self._file.read(shape[0] * shape[1] * 8), np.int64).reshape(shape)

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """Runs of a queue in order; entries pushed meanwhile come last. Empties it."""
        parts = self._parts[symbol]
        while parts:
            run, size = [], 0
            while parts and size < RUN:
                part = parts.pop(0)
                if isinstance(part, np.ndarray):
                    self._held -= part.shape[1]
                run.append(self._read(part))
                size += run[-1].shape[1]
            entries = run[0] if len(run) == 1 else np.concatenate(run, axis=1)
            for at in range(0, entries.shape[1], RUN):
                yield entries[:, at : at + RUN]

    def forwards(self, symbol: int) -> Iterator[np.ndarray]:
        """Runs of a queue in order; keeps it."""
        for part in self._parts[symbol]:
            yield self._read(part)

    def backwards(self, symbol: int) -> Iterator[np.ndarray]:
        """Runs of a queue from its end, each in order."""
        for part in reversed(self._parts[symbol]):
            entries = self._read(part)
            for at in reversed(range(0, entries.shape[1], RUN)):
                yield entries[:, at : at + RUN]


class _Minima:
    """Range minima of one run."""

    def __init__(self, values: np.ndarray):
        self._levels = [values]
        step = 1
        while 2 * step <= len(values):
            last = self._levels[-1]
            self._levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each closed range."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            table = self._levels[k]
            out[some] = np.minimum(table[first[some]], table[last[some] - (1 << k) + 1])
        return out


class _Sweep:
    """Hands what a run of the sweep induces to the queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queues: Queues, cap: int, plain: bool):
        self._text, self._wanted, self._queues, self._cap = text, wanted, queues, cap
        self._plain = plain  # without common prefixes
        # Least common prefix since a symbol's queue last grew.
        self._since = np.zeros(SYMBOLS, np.int64)

    def run(self, places: np.ndarray, common: np.ndarray) -> None:
        """``common`` is each entry's common prefix with the entry before it in the sweep."""
        before = places - 1
        chosen = np.flatnonzero((before >= 0) & self._wanted[before])
        least = 0 if self._plain else int(common.min())
        if not len(chosen):
            np.minimum(self._since, least, out=self._since)
            return
        symbol = self._text[before[chosen]]
        order = np.argsort(symbol, kind="stable")
        chosen, symbol = chosen[order], symbol[order]
        first = np.append(True, symbol[1:] != symbol[:-1])
        heads = np.flatnonzero(first)
        if self._plain:
            pair = np.stack([before[chosen], np.zeros(len(chosen), np.int64)])
            for a, b in zip(heads, np.append(heads[1:], len(chosen))):
                self._queues.push(int(symbol[a]), pair[:, a:b])
            return
        minima = _Minima(common)
        start = np.where(first, 0, np.append(0, chosen[:-1] + 1))
        shared = minima.of(start, chosen)
        shared[heads] = np.minimum(shared[heads], self._since[symbol[heads]])
        shared = np.minimum(shared + 1, self._cap)
        tails = np.append(heads[1:], len(chosen)) - 1
        np.minimum(self._since, least, out=self._since)
        rest = chosen[tails] + 1
        inside = rest < len(common)
        after = np.full(len(tails), self._cap, np.int64)
        after[inside] = minima.of(rest[inside], np.full(inside.sum(), len(common) - 1))
        self._since[symbol[tails]] = after
        pair = np.stack([before[chosen], shared])
        for a, b in zip(heads, tails + 1):
            self._queues.push(int(symbol[a]), pair[:, a:b])


def _repeated(sorted_: np.ndarray) -> np.ndarray:
    """Where a sorted array holds a value that it holds more than once."""
    same = sorted_[1:] == sorted_[:-1]
    return np.flatnonzero(np.append(same, False) | np.append(False, same))


class RepeatFinder:
    """Places of a sequence whose string of ``length`` also starts elsewhere.

    ``text`` holds symbols 0 to 256, where 0 separates parts. A separator may count as part of
    a string; the caller knows which places have ``length`` symbols before the next one.
    """

    def __init__(self, text: np.ndarray, length: int, held: int = HELD):
        text = np.append(text.astype(np.int16) + 1, np.int16(0))
        self._text, self._length, self._held = text, length, held
        n = len(text)
        change = np.flatnonzero(text[1:] != text[:-1]).astype(np.int32)
        stop = np.repeat(np.append(change, np.int32(n - 1)), np.diff(np.append(change, n - 1), prepend=-1))
        after = text[np.minimum(stop + 1, n - 1)]
        self._small = (text < after) & (stop < n - 1)  # S-type
        self._small[n - 1] = True
        self._run = stop + 1
        starts = self._small.copy()
        starts[1:] &= ~self._small[:-1]
        starts[0] = False
        self._starts = np.flatnonzero(starts)
        # Seven symbols from each place, nine bits each, the first lowest.
        self._sevens = np.zeros(n, np.uint64)
        for k in range(min(7, n)):
            self._sevens[: n - k] |= text[k:].astype(np.uint64) << np.uint64(9 * k)

    def _common(self, a: np.ndarray, b: np.ndarray, cap: np.ndarray | int) -> np.ndarray:
        """Common prefix of the suffixes at ``a`` and ``b``, up to ``cap``."""
        last = len(self._text) - 1
        out = np.zeros(len(a), np.int64)
        cap = np.broadcast_to(cap, len(a))
        open_, at, bt = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        while len(open_):
            # Past the end stands the lowest symbol, which no other place holds.
            differ = self._sevens[np.minimum(at, last)] ^ self._sevens[np.minimum(bt, last)]
            # The lowest bit that differs, a power of two and so exact as a float, tells the symbol.
            lowest = (differ & (~differ + np.uint64(1))).astype(float)
            gain = np.where(differ == 0, 7, (np.frexp(lowest)[1] - 1) // 9)
            out[open_] += gain
            more = np.flatnonzero((gain == 7) & (out[open_] < cap[open_]))
            open_, at, bt = open_[more], at[more] + 7, bt[more] + 7
        return np.minimum(out, cap)

    def _by_symbol(self, order: np.ndarray, common: np.ndarray) -> Queues:
        queues = Queues(self._held)
        symbol = self._text[order]
        heads = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])) if len(order) else []
        for a, b in zip(heads, np.append(heads[1:], len(order)) if len(order) else []):
            queues.push(int(symbol[a]), np.stack([order[a:b], common[a:b]]))
        return queues

    def _seam(self, a: int, b: int) -> int:
        """Common prefix of an L-type and an S-type suffix of one symbol: the shorter run."""
        return int(min(self._run[a] - a, self._run[b] - b, self._cap))

    def _induce(self, order: np.ndarray, common: np.ndarray, plain: bool = False) -> tuple[Queues, Iterator[tuple[int, np.ndarray]]]:
        """L-type suffixes by symbol, and the S-type ones in descending order by symbol."""
        n = len(self._text)
        self._cap = self._length
        start = self._by_symbol(order, common)
        queues, large = Queues(self._held), Queues(self._held)
        sweep = _Sweep(self._text, ~self._small, queues, self._cap, plain)
        for symbol in range(SYMBOLS):
            last = None
            for entries in queues.take(symbol):
                places, shared = entries
                shared = shared.copy()
                if last is None:
                    shared[0] = 0
                large.push(symbol, np.stack([places, shared]))
                sweep.run(places, shared)
                last = int(places[-1])
            for entries in start.take(symbol):
                places, shared = entries
                shared = shared.copy()
                if last is not None and last >= 0:
                    shared[0] = self._seam(last, int(places[0]))
                elif last is None:
                    shared[0] = 0
                sweep.run(places, shared)
                last = -1
        return large, self._descend(large, n, plain)

    def _descend(self, large: Queues, n: int, plain: bool) -> Iterator[tuple[int, np.ndarray]]:
        queues = Queues(self._held)
        sweep = _Sweep(self._text, self._small, queues, self._cap, plain)
        queues.push(0, np.array([[n - 1], [0]]))
        for symbol in reversed(range(SYMBOLS)):
            last = None
            for entries in queues.take(symbol):
                places, shared = entries
                shared = shared.copy()
                if last is None:
                    shared[0] = 0
                yield symbol, np.stack([places, shared])
                sweep.run(places, shared)
                last = int(places[-1])
            carried = 0 if last is None else None
            for entries in large.backwards(symbol):
                places, shared = entries[0][::-1], entries[1]
                # Backwards, an entry's common prefix is that noted with the one after it.
                head = self._seam(int(places[0]), last) if carried is None else carried
                carried = int(shared[0])
                sweep.run(places, np.append(head, shared[1:][::-1]))

    def _sorted_starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Starting suffixes in order, equal ones in any, and their common prefixes."""
        starts, n = self._starts, len(self._text)
        if not len(starts):
            return starts, np.zeros(0, np.int64)
        unsorted = starts[np.argsort(self._text[starts], kind="stable")]
        large, small = self._induce(unsorted, np.zeros(len(starts), np.int64), plain=True)
        is_start = np.zeros(n, bool)
        is_start[starts] = True
        found = [e[0][is_start[e[0]]] for _, e in small]
        order = np.concatenate(found)[::-1]
        index = np.full(n, -1, np.int64)
        index[starts] = np.arange(len(starts))
        size = np.append(np.diff(starts), 0) + 1
        own = index[order]
        length = size[own]
        same = np.append(False, (length[1:] == length[:-1]) & (self._common(order[1:], order[:-1], length[1:]) >= length[1:]))
        name = np.empty(len(starts) + 1, np.int64)
        name[own] = np.cumsum(~same)
        name[-1] = 0
        # Ranks of growing length over the sequence of names, until the strings are long enough.
        # A rank is one more than the number of smaller strings; only those that several places
        # hold and that are shorter than what is asked for are told apart further.
        count = len(starts)
        order, bits = own, (count + 1).bit_length()
        several, step = 63 // bits, 1
        name[order] = np.maximum.accumulate(np.where(same, 0, np.arange(count))) + 1
        open_ = _repeated(name[order])
        reach = np.append(starts, n)
        while len(open_):
            at = order[open_]
            key = name[at]
            for k in range(1, several):
                key = (key << bits) + name[np.minimum(at + k * step, count)]
            by = np.argsort(key)
            key, at, old = key[by], at[by], name[at[by]]
            order[open_] = at
            new = np.append(True, key[1:] != key[:-1])
            group = np.append(True, old[1:] != old[:-1])
            places = np.arange(len(at))
            heads = np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(group, places, 0))
            name[at] = old + heads
            step *= several
            some = _repeated(name[at])
            short = reach[np.minimum(at[some] + step, count)] - starts[at[some]] < self._length
            open_ = open_[some[short]]
        # Strings of one rank are as long as what is asked for.
        common = np.full(count, self._length, np.int64)
        common[0] = 0
        differ = np.flatnonzero(np.diff(name[order]))
        common[differ + 1] = self._common(starts[order[differ]], starts[order[differ + 1]], self._length)
        return starts[order], common

    def places(self) -> np.ndarray:
        """A mask over all places."""
        hit = np.zeros(len(self._text), bool)

        def mark(runs: Iterable[np.ndarray]) -> int | None:
            last = None
            for places, shared in runs:
                long = shared >= self._length
                if last is not None and long[0]:
                    hit[last] = True
                hit[places[long]] = True
                hit[places[:-1][long[1:]]] = True
                last = int(places[-1])
            return last

        order, common = self._sorted_starts()
        large, small = self._induce(order, common)
        ends: dict[int, int] = {}
        at = last = None
        for symbol, entries in small:
            if symbol != at:
                at, last = symbol, None
            places, shared = entries
            long = shared >= self._length
            if last is not None and long[0]:
                hit[last] = True
            hit[places[long]] = True
            hit[places[:-1][long[1:]]] = True
            last = int(places[-1])
            ends[symbol] = last
        for symbol in range(SYMBOLS):
            last = mark(large.forwards(symbol))
            if last is not None and symbol in ends and self._seam(last, ends[symbol]) >= self._length:
                hit[[last, ends[symbol]]] = True
        return hit[:-1]
