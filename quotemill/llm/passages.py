"""Substring dedup: near-duplicate passages across documents by compact windows.

A document is the sequence of its hashed word shingles. A compact window (l, c, r) says
that every subsequence from l..c to c..r has its min-hash at c; these are the nodes of the
Cartesian tree over the hashes, of which only those at least as wide as ``least_run`` count.

Every edit costs a passage at least as many shingles as overlap it, so two passages that are
similar enough have a run of ``least_run`` shingles in common, unchanged, whatever their
surroundings; the run has one min-hash, and both documents a window with this centre. So no
passage is missed by its hashes (those that repeat their own shingles aside). Of a run that
long at least one of three shorter stretches around the centre lies inside it: behind, about
and before it. Each is a key; what shares a key is a candidate, and the words decide.

A stretch of one shingle again and again ("the the the ...") says little and has many places
in one text. Passages need more in common, next to the run of that shingle or elsewhere, unless
the run alone is as long as a passage. So such a stretch gives way to two that pass the ends of
its run by one shingle, and to a few inside, whose key is for runs alone: there those as long as
a passage meet the first document, and shorter ones the last of the long, which may hold them;
shorter ones do not meet each other.

Equal texts are one text here: copies of one are listed with its first document, as wholes.
Places of one key are not all compared with each other but with heads, the first of the key.
A place is settled for its key when a verified passage with a head of this key holds the
key's whole stretch; a passage by another key, or one that ends inside the stretch, settles
nothing. While a key has a place that is not settled, such places become its next heads,
``_MORE_HEADS`` times as many a round, and meet all others of the key but earlier heads,
settled or not. So a passage in very many documents is done in one round and gives links in
proportion. Two places settled for a key by different heads are each listed with theirs.

Words are hashed once (64 bits) and shingles combine these, so that both the windows and the
comparison work on arrays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .components import components
from .substring_repeats import _keyed, _unpacked
from .tables import map_arrow, kept


class Settings(NamedTuple):
    shingle: int = 5  #: words of a shingle
    words: int = 50  #: words of the shortest passage
    similarity: float = 0.8  #: Jaccard similarity of shingles
    gap: int = 10  #: shingles without a partner that end a passage


_SEED = 0x9E3779B97F4A7C15
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BASE = 0x9E3779B97F4A7C15  #: odd, so that it has an inverse
#: Growth of the heads of a key from round to round.
_MORE_HEADS = 8
_FOUND = "uid long, a_start int, a_end int, other long, b_start int, b_end int, similarity double"
#: Shingles of one piece of a very long text.
PIECE = 1 << 22


def shingles(words: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def _table(n: int, seed: int) -> np.ndarray:
    return _spread(np.arange(1, n + 1, dtype=np.uint64), seed)


class Words:
    """Where the words of a text are (bytes, ends exclusive) and one 64-bit hash of each.

    A word's hash is a polynomial over its bytes with A-Z in lower case, taken for all words
    at once from the running sum of the text.
    """

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.hashes = np.zeros(len(self.start), np.uint64)
        for i in range(0, len(self.start), _BLOCK):
            start, end = self.start[i : i + _BLOCK], self.end[i : i + _BLOCK]
            part = data[start[0] : end[-1]]
            power, back = _powers(_BASE, len(part)), _powers(pow(_BASE, -1, 1 << 64), len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTES[part] * power[: len(part)], out=sums[1:])
            words = (sums[end - start[0]] - sums[start - start[0]]) * back[start - start[0]]
            self.hashes[i : i + _BLOCK] = _spread(words, _SEED + 2)


#: Words hashed at once.
_BLOCK = 1 << 18
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of a base by place, kept for the next text and more than ``n``."""
    known = _POWERS.get(base)
    if known is None or len(known) <= n:
        steps = np.full(max(1 << 16, n + 1), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps)
    return known


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word of a text, A-Z in lower case."""
    return Words(text).hashes


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per shingle of ``size`` words."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for j in range(size if len(out) else 0):
        out = out * np.uint64(_BASE) + words[j : j + len(out)]
    return out


def _spread(hashes: np.ndarray, seed: int) -> np.ndarray:
    out = (hashes ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(32))


#: A number per byte; upper case has that of lower case.
_BYTES = _table(256, _SEED)
_BYTES[65:91] = _BYTES[97:123]


def least_run(settings: Settings) -> int:
    """Shingles that two passages just similar enough share in one unchanged run, at least.

    Passages of n shingles with c in common have c >= t (2 n - c). A place where a run ends
    inside both costs either one size - 1 shingles, which bounds the number of runs by c.
    """
    n, t = settings.words - settings.shingle + 1, settings.similarity
    least = math.ceil(2 * n * t / (1 + t) - 1e-9)
    if t >= 1:
        return least
    lost = 2 * (settings.shingle - 1) * t / (1 - t)
    runs = (math.ceil(max(least, math.ceil(lost * k - 1e-9)) / (k + 1)) for k in range(n))
    return max(1, min(runs))


def _stretches(run: int) -> list[tuple[int, int]]:
    """First and last shingle, from the centre, of stretches of which any run that holds the
    centre holds one."""
    half = run // 3
    return [(-2 * half, 0), (-half, half), (0, 2 * half)]


def compact_windows(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c and r of all compact windows at least ``width`` wide.

    A node of the Cartesian tree is that wide if and only if it is the minimum of some window
    of that width, and all its ancestors are too; so the tree is built over these minima.
    Of equal values the leftmost counts as the smallest.
    """
    n = len(values)
    if n < width:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    low = np.uint64((1 << 24) - 1)
    least = full = (values & ~low) | np.arange(n, dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step:
        least = np.minimum(least[: step - width], least[width - step :])
    place = (least & low).astype(np.int64)
    centre = place[np.append(True, place[1:] != place[:-1])]
    listed, at = full[centre].tolist(), centre.tolist()
    left, right, stack = [0] * len(at), [n - 1] * len(at), []
    for i, value in enumerate(listed):
        while stack and listed[stack[-1]] > value:
            right[stack.pop()] = at[i] - 1
        left[i] = at[stack[-1]] + 1 if stack else 0
        stack.append(i)
    return np.array(left), centre, np.array(right)


def _window_table(keyed: DataFrame, settings: Settings) -> DataFrame:
    """``key, uid, c, behind, about, before, alone, long``: centres with hashes of the stretches.

    A stretch that an end of the text cuts off has no hash, nor has one of a single shingle
    again and again. What stands for those follows in rows of its own, in ``before`` and
    ``alone``; ``long`` is false where the run of ``alone`` is shorter than a passage.
    """
    width = least_run(settings)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out: list[list] = [[pa.array([], t)] for t in (pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.bool_())]
            for uid, text in zip(batch["uid"].to_pylist(), batch["text"].to_pylist()):
                words = word_hashes(text.encode())
                if len(words) < settings.words:
                    continue
                whole = shingle_hashes(words, settings.shingle)
                for at in range(0, max(1, len(whole) - width + 1), PIECE):
                    # With what the stretches of the piece's centres reach.
                    low = max(0, at - width)
                    values = _spread(whole[at : at + PIECE + width - 1], _SEED)
                    near = _spread(whole[low : at + PIECE + 2 * width], _SEED)
                    _, c, _ = compact_windows(values, width)
                    c = c.astype(np.int64) + (at - low)
                    sides = _stretches(width)
                    size = sides[0][1] - sides[0][0] + 1
                    sums = _runs(near, size)
                    runs = _Uniform(near, size)
                    inside = [runs.holding(c + first) for first, _ in sides]
                    used = np.unique(np.concatenate(inside))
                    head, tail = runs.ends(used[used >= 0])
                    told = np.min(inside, 0) < 0
                    c, inside = c[told], [held[told] for held in inside]
                    edge = np.concatenate([head - 1, tail + 2 - size])
                    fresh = ~np.isin(edge, c[inside[2] < 0])
                    edge, of = edge[fresh], np.concatenate([head, head])[fresh]
                    long = tail - head + settings.shingle >= settings.words
                    within, own = runs.places(head, np.where(long, tail + 1 - size, head), settings.words + width)
                    kind = np.repeat([0, 1, 2], [len(c), len(edge), len(within)])
                    key, place = near[np.concatenate([c, of, within])], np.concatenate([c, edge, within])
                    row = [pa.array(key.view(np.int64)), pa.array(np.full(len(place), uid)), pa.array(place + low, pa.int32())]
                    for (first, _), held in zip(sides, inside):
                        without = kind > (1 if first == 0 else 0)
                        without[: len(c)] = held >= 0
                        row.append(_at(sums, place + first, without))
                    row += [_at(sums, place, kind < 2), pa.array(np.append(np.ones(len(c) + len(edge), bool), long[own]))]
                    for column, part in zip(out, row):
                        column.append(part)
            yield [pa.concat_arrays(column) for column in out]

    return map_arrow(keyed, run, "key long, uid long, c int, behind int, about int, before int, alone int, long boolean")


def _runs(values: np.ndarray, length: int) -> np.ndarray:
    """24-bit hashes of all runs of ``length`` values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    total, done, part, size = np.zeros(n, np.uint64), 0, values, 1
    while done < length:
        if length & size:
            total = total * np.uint64(pow(_BASE, size, 1 << 64)) + part[done : done + n]
            done += size
        if done < length:
            part = part[: len(part) - size] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:]
            size *= 2
    return (_spread(total, 1) >> np.uint64(40)).astype(np.int32)


class _Uniform:
    """Runs of one value again and again, at least ``size`` long (none, if that is one)."""

    def __init__(self, values: np.ndarray, size: int):
        self._size = size
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        last = np.append(first[1:], len(values)) - 1
        long = (last - first + 1 >= size) & (size > 1)
        self._first, self._last = first[long], last[long]

    def holding(self, places: np.ndarray) -> np.ndarray:
        """The number of the run that holds the whole stretch from each place; -1 for none."""
        if not len(self._first):
            return np.full(len(places), -1)
        run = np.searchsorted(self._first, places, "right") - 1
        return np.where((run >= 0) & (places + self._size - 1 <= self._last[run]), run, -1)

    def ends(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of runs."""
        return self._first[runs], self._last[runs]

    @staticmethod
    def places(first: np.ndarray, last: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from each first to its last, both included, not further apart than ``step``;
        and the number of their pair."""
        count = -(-(last - first) // step) + 1
        own = np.repeat(np.arange(len(first)), count)
        at = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        return np.minimum(first[own] + step * at, last[own]), own


def _at(sums: np.ndarray, places: np.ndarray, without: np.ndarray) -> pa.Array:
    """The values at places; none for places outside and where ``without`` says so."""
    outside = without | (places < 0) | (places >= len(sums))
    values = sums[np.where(outside, 0, places)] if len(sums) else np.zeros(len(places), np.int32)
    return pa.array(values, pa.int32(), mask=outside)


def _members(windows: DataFrame, settings: Settings) -> DataFrame:
    """``k, uid, c, first, last, settled, hu, hc``: the places of every key that two documents have.

    ``first`` and ``last`` are the shingles at the ends of the key's stretch, ``hu, hc`` is
    the key's first head; for a run shorter than a passage the last that is as long.
    """
    shared = windows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    stretches = _stretches(least_run(settings))
    sides = [
        F.when(F.col(x).isNotNull(), F.struct(F.xxhash64("key", F.lit(i), x).alias("k"), (F.col("c") + a).alias("first"), (F.col("c") + b).alias("last")))
        for i, (x, (a, b)) in enumerate(zip(("behind", "about", "before", "alone"), [*stretches, stretches[-1]]))
    ]
    listed = kept(windows.join(shared, "key").select(F.inline(F.array_compact(F.array(*sides))), "uid", "c", "long"), "places")
    place = F.struct("uid", "c")
    ends = F.min(place).alias("head"), F.max(F.when(F.col("long"), place)).alias("tail")
    keys = listed.groupBy("k").agg(*ends, (F.min("uid") < F.max("uid")).alias("several")).where("several AND tail IS NOT NULL")
    met = F.when(F.col("long"), F.col("head")).otherwise(F.col("tail"))
    members = listed.join(keys.select("k", "head", "tail"), "k").withColumn("met", met).where("long OR uid < met.uid")
    members = members.select("k", "uid", "c", "first", "last", (~F.col("long")).alias("settled"), F.col("met.uid").alias("hu"), F.col("met.c").alias("hc"))
    members = kept(members, "members")
    _forget(listed)
    return members


#: Width of a band of diagonals.
BAND = 64


def _candidates(links: DataFrame, settings: Settings) -> DataFrame:
    """``uid, other, a, b, c, d`` of linked centres ``uid, c, other, oc``.

    A region per pair and band of diagonals, in shingles (ends inclusive) that may pass those
    of the texts. Parts of a passage without a run of their own are at most twice as long as
    those with one, which bounds its ends; of a passage that lies in several bands the region
    of one holds all.
    """
    run, n = least_run(settings), settings.words
    band = F.floor((F.col("c") - F.col("oc")) / BAND).cast("int").alias("band")
    ends = [f("c" if i < 2 else "oc").alias(x) for i, (f, x) in enumerate(zip((F.min, F.max, F.min, F.max), "lhxy"))]
    more = 2 * (F.col("h") - F.col("l") + 2 * run) + n
    return links.groupBy("uid", "other", band).agg(*ends).select(
        "uid", "other", F.greatest(F.lit(0), F.col("l") - more).alias("a"), (F.col("h") + more).alias("b"),
        F.greatest(F.lit(0), F.col("x") - more).alias("c"), (F.col("y") + more).alias("d"),
    )


class Shingles:
    """Shingle hashes of the text that others are compared with, numbered and sorted."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.listed, self.first, self.number = np.unique(values, return_index=True, return_inverse=True)

    def numbers(self, mine: np.ndarray) -> np.ndarray:
        """The number of every given shingle here; -1 for those that are not here."""
        if not len(self.listed):
            return np.full(len(mine), -1)
        at = np.minimum(np.searchsorted(self.listed, mine), len(self.listed) - 1)
        return np.where(self.listed[at] == mine, at, -1)


def _possible(mine: np.ndarray, alone: np.ndarray, settings: Settings) -> bool:
    """Whether any part as long as a passage has few enough shingles without a partner."""
    least, lost = settings.words - settings.shingle + 1, np.flatnonzero(alone)
    if len(mine) < least:
        return False
    if len(np.unique(mine[lost])) < len(lost):
        return True  # repeated ones count once, so their places say nothing
    # A little is forgiven, so that no sum is too small by rounding.
    sums = np.append(0.0, np.cumsum(1 - settings.similarity - alone)) + 1e-9 * np.arange(len(mine) + 1)
    highest = np.maximum.accumulate(sums[:least - 1 : -1])[::-1]
    return bool((sums[: len(highest)] <= highest).any())


def similar_parts(mine: np.ndarray, others: Shingles, settings: Settings) -> list[tuple[int, int, int, int, float]]:
    """Passages of a text (its shingle hashes) with similar ones in another.

    Ends are exclusive and count words. Shingles of ``mine`` that ``others`` has too are cut
    where the gap is passed; a part that is not similar enough is cut again at its widest
    gap, as long as the pieces can be passages.
    """
    numbers = others.numbers(mine)
    met = np.flatnonzero(numbers >= 0)
    if not _possible(mine, numbers < 0, settings):
        return []
    shift = others.first[numbers[met]] - met
    tail, out = settings.shingle - 1, []
    ends = [0, *(np.flatnonzero(np.diff(met) > settings.gap) + 1).tolist(), len(met)]
    waiting = list(zip(ends, ends[1:]))
    while waiting:
        x, y = waiting.pop()
        if x == y or met[y - 1] + 1 - met[x] + tail < settings.words:
            continue
        start, end = int(met[x]), int(met[y - 1]) + 1
        offset = int(np.median(shift[x:y]))
        low, high = max(0, start + offset - settings.gap), min(len(others.values), end + offset + settings.gap)
        ours = np.zeros(len(others.listed), bool)
        ours[numbers[met[x:y]]] = True
        inside = np.flatnonzero(ours[others.number[low:high]])
        if len(inside):
            low, high = low + int(inside[0]), low + int(inside[-1]) + 1
            theirs = np.zeros(len(others.listed), bool)
            theirs[others.number[low:high]] = True
            alone = mine[start:end][numbers[start:end] < 0]
            common = int((ours & theirs).sum())
            union = int((ours | theirs).sum()) + len(np.unique(alone))
            if common / union >= settings.similarity:
                out.append((start, end + tail, low, high + tail, common / union))
                continue
        gaps = np.diff(met[x:y])
        widest = int(np.argmax(gaps)) + 1 if len(gaps) else 0
        if widest and gaps[widest - 1] > 1:
            waiting += [(x, x + widest), (x + widest, y)]
    return sorted(out)


def _packed(keyed: DataFrame) -> DataFrame:
    """``uid, packed, size``: texts lightly compressed for their way through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data = [t.encode() for t in batch["text"].to_pylist()]
            yield batch["uid"], [pa.compress(d, "zstd", asbytes=True) if d else b"" for d in data], [len(d) for d in data]

    return map_arrow(keyed, run, "uid long, packed binary, size long")


def _verified(candidates: DataFrame, packed: DataFrame, settings: Settings) -> DataFrame:
    """``uid, a_start, a_end, other, b_start, b_end, similarity``, ends exclusive, in words."""

    def cut(batches: Iterator[pa.RecordBatch]):
        last, data, words = None, b"", Words(b"")
        for batch in batches:
            sizes, parts = [], []
            for uid, a, b, i in zip(*[batch[x].to_pylist() for x in ("uid", "a", "b")], range(batch.num_rows)):
                if uid != last:
                    last, data = uid, _unpacked(batch["packed"][i].as_py(), batch["size"][i].as_py())
                    words = Words(data)
                end = min(b + settings.shingle, len(words.end))
                part = data[words.start[a] : words.end[end - 1]] if a < end else b""
                sizes.append(len(part))
                parts.append(pa.compress(part, "zstd", asbytes=True) if part else b"")
            yield *[batch[x] for x in ("uid", "other", "a", "c", "d")], sizes, parts

    schema = "uid long, other long, a int, c int, d int, part_size long, part binary"
    mine = map_arrow(candidates.join(packed, "uid"), cut, schema)
    both = mine.join(packed.select(F.col("uid").alias("other"), "packed", "size"), "other")

    def check(batches: Iterator[pa.RecordBatch]):
        last, whole, ends, there = None, np.zeros(0, np.uint64), None, None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            listed = [batch[x].to_pylist() for x in ("uid", "other", "a", "c", "d", "part_size", "part")]
            for i, (uid, other, a, c, d, size, part) in enumerate(zip(*listed)):
                if other != last:
                    last, ends = other, None
                    whole = shingle_hashes(word_hashes(_unpacked(batch["packed"][i].as_py(), batch["size"][i].as_py())), settings.shingle)
                if ends != (c, min(d + 1, len(whole))):
                    ends = c, min(d + 1, len(whole))
                    there = Shingles(whole[ends[0] : ends[1]])
                mine = shingle_hashes(word_hashes(_unpacked(part, size)), settings.shingle)
                for s, e, x, y, alike in similar_parts(mine, there, settings):
                    row = uid, a + s, a + e, other, c + x, c + y, alike
                    for column, cell in zip(out, row):
                        column.append(cell)
            yield out

    return map_arrow(both, check, _FOUND)


def _class_of(table: DataFrame, name: str = "root") -> list:
    return [F.col("root").alias(name)] if "root" in table.columns else []


def _head_links(members: DataFrame, heads: DataFrame | None) -> DataFrame:
    """``uid, c, other, oc``: places of a key with its heads, the larger document first."""
    own = F.struct("uid", "c").alias("a")
    if heads is None:
        both = members.select(own, F.struct(F.col("hu").alias("uid"), F.col("hc").alias("c")).alias("b"))
    else:
        both = members.select("k", own, *_class_of(members)).join(heads.select("k", F.struct("uid", "c").alias("b"), *_class_of(heads, "met")), "k")
        if "root" in members.columns:
            both = both.where("root <> met")
    high, low = F.greatest("a", "b"), F.least("a", "b")
    named = [high["uid"].alias("uid"), high["c"].alias("c"), low["uid"].alias("other"), low["c"].alias("oc")]
    return both.where("a.uid <> b.uid").select(named)


def _open_members(members: DataFrame, heads: DataFrame | None, found: DataFrame, settings: Settings) -> DataFrame:
    """The members of the next round: without the heads, of keys with a place not settled.

    No earlier document can cover a place of a key's first one, so these count as settled;
    heads to come still meet them. Without ``heads`` they are the members' own first ones.
    """
    mine = found.select("uid", "other", "a_start", "a_end")
    theirs = found.select(F.col("other").alias("uid"), F.col("uid").alias("other"), F.col("b_start").alias("a_start"), F.col("b_end").alias("a_end"))
    place, waiting, settled = ["k", "uid", "c", "first"], members.where("NOT settled"), F.col("settled")
    if heads is None:
        met = waiting.where("uid <> hu").select(*place, "last", F.col("hu").alias("other"))
        rest = members.where("uid <> hu OR c <> hc")
        settled = settled | (F.col("uid") == F.col("hu"))
    else:
        met = waiting.join(heads.select("k", F.col("uid").alias("other")).distinct(), "k")
        rest = members.join(heads.select("k", "uid", "c"), ["k", "uid", "c"], "left_anti")
    covered = (
        met.join(mine.union(theirs).distinct(), ["uid", "other"])
        .where((F.col("first") >= F.col("a_start")) & (F.col("last") + settings.shingle <= F.col("a_end")))
        .select(*place, F.lit(True).alias("covered")).distinct()
    )
    settled = settled | F.coalesce("covered", F.lit(False))
    rest = rest.join(covered, place, "left").select(*place, "last", settled.alias("settled"))
    keys = rest.groupBy("k").agg((~F.every("settled") & (F.min("uid") < F.max("uid"))).alias("open")).where("open")
    return rest.join(keys.select("k"), "k").select("k", "uid", "c", "first", "last", "settled")


def _copies(keyed: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The first row of every text, and the pairs of its copies with it."""
    marked = keyed.withColumn("same", F.sha2("text", 256))
    firsts = marked.groupBy("same").agg(F.min("uid").alias("least"), F.count("*").alias("rows"))
    firsts = kept(firsts, "firsts")
    distinct = keyed.join(firsts.select(F.col("least").alias("uid")), "uid", "left_semi")
    repeated = marked.join(firsts.where("rows > 1"), "same").where("uid <> least").select("uid", "least", "text")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sizes = np.array([len(t.encode().split()) for t in batch["text"].to_pylist()], np.int32)
            long, n = pa.array(sizes >= settings.words), pa.array(sizes)
            zero, one = pa.array(np.zeros(len(sizes), np.int32)), pa.array(np.ones(len(sizes)))
            yield [x.filter(long) for x in (batch["uid"], zero, n, batch["least"], zero, n, one)]

    return distinct, map_arrow(repeated, run, _FOUND)


def _prepared(keyed: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members, texts packed for comparison, and the pairs of copies."""
    distinct, copies = _copies(keyed, settings)
    windows = kept(_window_table(distinct, settings), "windows")
    members = _members(windows, settings)
    _forget(windows)
    packed = kept(_packed(distinct.join(members.select("uid").distinct(), "uid", "left_semi")), "packed")
    return members, packed, copies


def _near_passages(keyed: DataFrame, settings: Settings) -> DataFrame:
    """Verified pairs by key (``_FOUND``) of the rows ``uid, text``."""
    members, packed, found = _prepared(keyed, settings)
    count = 1
    while count == 1 or not members.isEmpty():
        heads = None
        if count > 1:
            order = Window.partitionBy("k").orderBy("uid", "c")
            heads = members.where("NOT settled").withColumn("n", F.row_number().over(order)).where(F.col("n") <= count)
            heads = kept(heads.select("k", "uid", "c"), "heads")
        links = _head_links(members, heads)
        now = kept(_verified(_candidates(links, settings), packed, settings), "passages")
        rest = kept(_open_members(members, heads, now, settings), "members")
        for done in (members, heads):
            _forget(done)
        members, found, count = rest, found.union(now), _MORE_HEADS * count
    return found.distinct()


def _merged(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """``uid, root``: the smallest document that verified pairs lead to, after more of them."""
    pairs = found.select(F.col("uid").alias("u"), F.col("other").alias("v"))
    if roots is None:
        return components(pairs).toDF("uid", "root")
    u, v = roots.toDF("u", "ru"), roots.toDF("v", "rv")
    pairs = pairs.join(u, "u", "left").join(v, "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    more = components(pairs).toDF("root", "into")
    old = roots.join(more, "root", "left").select("uid", F.coalesce("into", "root").alias("root"))
    return old.union(more.toDF("uid", "root").join(roots, "uid", "left_anti"))


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))


def _joining_passages(keyed: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Verified pairs (``_FOUND``) that lead from every document to all of its class; and ``uid, root``.

    A document meets the head of most of its keys first, then its other heads, then in rounds
    the members of keys that hold several classes still, unless the two are in one class by
    then. Every two members of a key are compared or in one class at the end (of runs shorter
    than a passage, those that the key compares at all).
    """
    members, packed, copies = _prepared(keyed, settings)
    met = members.where("uid <> hu").groupBy("uid", "hu").agg(F.count("*").alias("n"))
    most = met.groupBy("uid").agg(F.min(F.struct((-F.col("n")).alias("n"), "hu"))["hu"].alias("hu"))
    most = kept(most, "most")
    now = kept(_verified(_candidates(_head_links(members.join(most, ["uid", "hu"]), None), settings), packed, settings), "passages")
    found, roots, count = now, kept(_merged(None, now), "roots"), 1
    apart = _rooted(members.join(most, ["uid", "hu"], "left_anti"), roots)
    apart = apart.join(roots.toDF("hu", "met"), "hu", "left").where(F.col("root") != F.coalesce("met", "hu"))
    now = kept(_verified(_candidates(_head_links(apart, None), settings), packed, settings), "passages")
    rest = members.where("uid <> hu OR c <> hc").select("k", "uid", "c", "settled")
    while True:
        found = found.union(now)
        if not now.isEmpty():
            roots = kept(_merged(roots, now), "roots")
        left = kept(_of_several(_rooted(rest, roots)), "members")
        _forget(members)
        members = left
        if members.isEmpty():
            return found.union(copies), kept(_merged(roots, copies), "roots")
        own, all_of = Window.partitionBy("k", "root").orderBy("uid", "c"), Window.partitionBy("k").orderBy("n", "uid", "c")
        heads = members.where("NOT settled").withColumn("n", F.row_number().over(own)).where(F.col("n") <= count)
        heads = heads.withColumn("m", F.row_number().over(all_of)).where(F.col("m") <= _MORE_HEADS * count)
        heads = kept(heads.select("k", "uid", "c", "root"), "heads")
        links = _head_links(members, heads)
        now = kept(_verified(_candidates(links, settings), packed, settings), "passages")
        rest = members.join(heads.select("k", "uid", "c"), ["k", "uid", "c"], "left_anti").select("k", "uid", "c", "settled")
        count *= _MORE_HEADS


def _of_several(rooted: DataFrame) -> DataFrame:
    """The members of keys whose places to be settled are of several classes."""
    root = F.when(~F.col("settled"), F.col("root"))
    keys = rooted.groupBy("k").agg((F.min(root) < F.max(root)).alias("several")).where("several")
    return rooted.join(keys.select("k"), "k")


def _forget(table: DataFrame | None) -> None:
    """Delete a stored table that no later step reads."""
    files = table.inputFiles() if table is not None else []
    if files:
        jvm, session = table.sparkSession._jvm, table.sparkSession._jsparkSession
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(session.sessionState().newHadoopConf()).delete(folder, True)


def near_passages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Verified pairs of near-duplicate passages of different documents.

    ``doc_id, start_word, end_word, other_doc_id, other_start_word, other_end_word,
    similarity``, with ends exclusive. The other document is a head, a smaller id that many
    may share; two documents with one head at one place are not listed with each other again,
    and a copy of a whole text only with the text's first document. Documents without such a
    passage give no row; null and short texts have none; repeated rows pair like other
    documents.
    """
    keyed = _keyed(docs)
    ids = keyed.select("uid", "doc_id")
    named = _near_passages(keyed, settings).join(ids, "uid").join(ids.toDF("other", "other_doc_id"), "other")
    return named.select(
        "doc_id", F.col("a_start").alias("start_word"), F.col("a_end").alias("end_word"), "other_doc_id",
        F.col("b_start").alias("other_start_word"), F.col("b_end").alias("other_end_word"), "similarity",
    )


def linked_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Classes of documents that near-duplicate passages link, one row per document.

    ``doc_id, component_id, start_word, end_word, other_doc_id, other_start_word,
    other_end_word, similarity``: the smallest id that passages lead to, directly or over
    others (its own, if there is none), and the longest passage of those that were verified
    for it, null without one. Documents of one class are not all compared with each other:
    the work follows the documents, not the pairs that are similar.
    """
    keyed = _keyed(docs)
    found, roots = _joining_passages(keyed, settings)
    other = found.select("other", "b_start", "b_end", "uid", "a_start", "a_end", "similarity")
    width, columns = (F.col("a_end") - F.col("a_start")).alias("width"), found.columns[1:]
    longest = found.union(other).groupBy("uid").agg(F.max(F.struct(width, *columns)).alias("p")).select("uid", *[f"p.{c}" for c in columns])
    ids = keyed.select("uid", "doc_id")
    least = roots.join(ids, "uid").groupBy("root").agg(F.min("doc_id").alias("least"))
    named = ids.join(roots, "uid", "left").join(least, "root", "left").join(longest, "uid", "left")
    named = named.join(ids.toDF("other", "other_doc_id"), "other", "left")
    return named.select(
        "doc_id", F.coalesce("least", "doc_id").alias("component_id"), F.col("a_start").alias("start_word"), F.col("a_end").alias("end_word"),
        "other_doc_id", F.col("b_start").alias("other_start_word"), F.col("b_end").alias("other_end_word"), "similarity",
    )


def _without(text: str | None, spans: list | None) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not text or not spans:
        return text
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for start, end in sorted((s[0], s[1]) for s in spans):
        a, b = places[start][0], places[end - 1][1]
        if b > at:
            out.append(data[at : max(at, a)])
            at = b
    return (b"".join(out) + data[at:]).decode()


def drop_repeated_passages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every near-duplicate passage cut from all rows but the first.

    All rows and columns stay; ``n_chars``, where there is one, follows the new text. The
    first is that of the smallest id; where ids repeat or are missing, rows are told apart by
    a stored number and the order is that of the numbers.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    rows, ids = plain.agg(F.count("*"), F.countDistinct(key)).first()
    if rows == ids:
        numbered = plain.withColumn("uid", F.col(key).cast("long"))
    else:
        numbered = kept(plain.withColumn("uid", F.monotonically_increasing_id()), "numbered")
    keyed = numbered.select("uid", F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    spans = _near_passages(keyed, settings).groupBy("uid").agg(F.collect_set(F.struct("a_start", "a_end")).alias("spans"))
    joined = numbered.join(spans, "uid", "left").select(*plain.columns, "spans")
    at = plain.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            columns = list(batch.columns)
            listed = [None if s is None else [(x["a_start"], x["a_end"]) for x in s] for s in columns.pop().to_pylist()]
            columns[at] = [_without(t, s) for t, s in zip(columns[at].to_pylist(), listed)]
            yield [*columns, [s is not None for s in listed]]

    done = map_arrow(joined, run, StructType([*plain.schema.fields, StructField("cut", BooleanType())]))
    if "n_chars" in names:
        chars = f"c{names.index('n_chars')}"
        done = done.withColumn(chars, F.when(F.col("cut"), F.length(text)).otherwise(F.col(chars)).cast(plain.schema[chars].dataType))
    return done.select(*plain.columns).toDF(*names)
