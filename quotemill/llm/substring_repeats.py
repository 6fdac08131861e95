"""Suffix-array dedup: bytes covered by a string of given length that also starts elsewhere.

Anchors route the work. Of each window of ``length`` bytes, the 32-byte gram with the
smallest hash is its anchor; equal windows have equal anchors, so a window can only repeat
one with the same anchor hash. Anchors whose hash occurs once are settled. For the others
the stretch of bytes that their windows span goes to the shard of the hash, and every shard
is searched by external induced sorting (``induced_sort``) without a look at other shards.

A stretch that stands twice repeats as a whole, so one copy of each is searched, for the
others of its hash; the answer then holds for all copies by a join. A hot stretch therefore
never gathers in one task, and a hash with a single stretch has nothing to be compared.
"""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import stored

from .induced_sort import RepeatFinder
from .tables import map_arrow, texts

LENGTH = 200
GRAM = 32
#: Bytes of a text whose anchors are found at a time.
PIECE = 1 << 21
#: Bytes that a shard takes before it is searched; it ends with a hash, so it may grow.
SHARD = 1 << 21
#: Stretches whose copies a task counts.
COUNTED = 500_000
#: Stretches with copies whose answers a task holds.
LISTED = 50_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place."""
    out = (data.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    for k, odd in zip((1, 2, 4, 8, 16), _ODD):
        out = out[:-k] * odd + (out[k:] ^ (out[k:] >> np.uint64(31)))
    out = (out ^ (out >> np.uint64(29))) * _ODD[1]
    return out ^ (out >> np.uint64(32))


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: hash, anchor's place, first window, windows.

    The anchor of a window is its gram with the smallest hash, the leftmost of equals.
    """
    found = []
    for at in range(0, max(1, len(data) - length + 1), PIECE):
        piece = data[at : at + PIECE + length - 1]
        if len(piece) < length:
            break
        grams = _grams(piece)
        low = np.uint64((1 << 24) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span, step = length - GRAM + 1, 1
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if span > step:
            least = np.minimum(least[: step - span], least[span - step :])
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        count = np.diff(np.append(first, len(place)))
        found.append((grams[place[first]].view(np.int64), place[first] + at, first + at, count))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


def _keyed(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, text``: the document's id as key, or a stored number where ids repeat."""
    own = texts(docs)
    rows, ids = own.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if rows == ids:
        return own.select(F.col("doc_id").alias("uid"), "doc_id", "text")
    return stored(own.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), "numbered")


def _packed(keyed: DataFrame) -> DataFrame:
    """``uid, doc_id, packed, size``: texts compressed for their way through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data = [t.encode() for t in batch["text"].to_pylist()]
            packed = [_compressed(d) for d in data]
            yield batch["uid"], batch["doc_id"], packed, [len(d) for d in data]

    return map_arrow(keyed, run, "uid long, doc_id long, packed binary, size long")


def _compressed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=9).compress(data, asbytes=True) if data else b""


def _unpacked(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, size, "zstd", asbytes=True) if size else b""


def _anchor_table(keyed: DataFrame, length: int) -> DataFrame:
    """``h, uid, loc`` per anchor; ``loc`` packs its place, first window and windows."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            hashes, uids, locs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for uid, text in zip(batch["uid"].to_pylist(), batch["text"].to_pylist()):
                h, place, first, count = anchors(np.frombuffer(text.encode(), np.uint8), length)
                hashes.append(h)
                uids.append(np.full(len(h), uid))
                locs.append((place << 24) | ((place - first) << 12) | count)
            yield np.concatenate(hashes), np.concatenate(uids), np.concatenate(locs)

    return map_arrow(keyed, run, "h long, uid long, loc long")


def _stretches(packed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``h, uid, first, b, copy, stretch``: the bytes that the wanted anchors' windows span.

    ``b`` is a hash of the stretch and ``copy`` numbers its copies in a task, 3 for all further
    ones. The bytes come with the first; others have null.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        met: Counter = Counter()
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for i in range(batch.num_rows):
                text = _unpacked(batch["packed"][i].as_py(), batch["size"][i].as_py())
                listed = batch["anchors"][i].values
                for h, loc in zip(listed.field(0).to_pylist(), listed.field(1).to_pylist()):
                    first = (loc >> 24) - (loc >> 12 & 0xFFF)
                    stretch = text[first : first + (loc & 0xFFF) + length - 1]
                    b = xxhash.xxh64_intdigest(stretch, 1) - (1 << 63)
                    if len(met) > COUNTED:
                        met.clear()
                    met[h, b] = copy = min(met[h, b] + 1, 3)
                    for column, value in zip(out, (h, batch["uid"][i].as_py(), first, b, copy, stretch if copy == 1 else None)):
                        column.append(value)
            yield out

    listed = wanted.groupBy("uid").agg(F.collect_list(F.struct("h", "loc")).alias("anchors"))
    joined = packed.join(listed, "uid").select("uid", "packed", "size", "anchors")
    return map_arrow(joined, run, "h long, uid long, first long, b long, copy int, stretch binary")


class _Shard:
    """Different stretches in one unnamed file, ended by separators, and their repeats."""

    def __init__(self, length: int):
        self._length, self._file = length, tempfile.TemporaryFile()
        self.size, self._keys, self._whole = 0, [], []

    def add(self, key: tuple[int, int], stretch: bytes) -> None:
        symbols = np.zeros(len(stretch) + 1, np.int16)
        symbols[:-1] = np.frombuffer(stretch, np.uint8)
        symbols[:-1] += 1
        self._file.write(symbols.tobytes())
        self._keys.append((key, self.size, self._windows(stretch)))
        self.size += len(symbols)

    def settle(self, key: tuple[int, int], stretch: bytes) -> None:
        """A stretch with copies: all its windows repeat."""
        self._whole.append((key, self._windows(stretch)))

    def _windows(self, stretch: bytes) -> int:
        return len(stretch) - self._length + 1

    def spans(self) -> tuple[list, list, list]:
        """Hash, stretch and the runs of its repeated windows, as start, end, start, …"""
        out: tuple[list, list, list] = ([], [], [])
        whole = {key for key, _ in self._whole}
        found = [(key, [0, windows]) for key, windows in self._whole]
        if self._keys:
            self._file.flush()
            hit = RepeatFinder(np.memmap(self._file, np.int16, mode="r"), self._length).places()
            for key, at, windows in self._keys:
                if key not in whole:
                    edge = np.flatnonzero(np.diff(hit[at : at + windows].astype(np.int8), prepend=0, append=0))
                    found.append((key, edge.tolist()))
        self._file.close()
        for key, runs in found:
            if runs:
                for column, value in zip(out, (*key, runs)):
                    column.append(value)
        return out


def _repeats(stretches: DataFrame, length: int) -> DataFrame:
    """``h, b, runs``: repeated windows of every distinct stretch that has any."""

    def run(batches: Iterator[pa.RecordBatch]):
        shard, listed = _Shard(length), 0
        last = first = None  # the stretch at hand, and that of its hash which waits for a second
        stretch, copies = b"", 0
        for batch in batches:
            rows = zip(batch["h"].to_pylist(), batch["b"].to_pylist(), batch["stretch"])
            for h, b, given in rows:
                if (h, b) == last:
                    copies += 1
                    if copies == 2:
                        shard.settle(last, stretch)
                        listed += 1
                    continue
                if last is None or h != last[0]:
                    if shard.size >= SHARD or listed >= LISTED:
                        yield shard.spans()
                        shard, listed = _Shard(length), 0
                    first = (h, b), given.as_py()
                    last, stretch, copies = *first, 1
                    continue
                if first is not None:
                    shard.add(*first)
                    first = None
                last, stretch, copies = (h, b), given.as_py(), 1
                shard.add(last, stretch)
        yield shard.spans()

    # Two rows of a stretch tell that it has copies; the bytes are in the first.
    given = stretches.where("copy < 3").select("h", "b", "copy", "stretch")
    count = int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sharded = given.repartition(count, "h").sortWithinPartitions("h", "b", "copy").select("h", "b", "stretch")
    return map_arrow(sharded, run, "h long, b long, runs array<int>")


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, packed, size, windows`` with the repeated windows of every document."""
    keyed = _keyed(docs)
    table = stored(_anchor_table(keyed, length), "anchors")
    shared = table.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    packed = _packed(keyed)
    stretches = stored(_stretches(packed, table.join(shared, "h"), length), "stretches")
    repeats = _repeats(stretches, length)
    windows = (
        stretches.select("h", "b", "uid", "first")
        .join(repeats, ["h", "b"])
        .groupBy("uid")
        .agg(F.collect_list(F.struct("first", "runs")).alias("windows"))
    )
    return packed.join(windows, "uid", "left").select("doc_id", "packed", "size", "windows")


def _spans(windows: pa.Scalar, length: int) -> np.ndarray:
    """Maximal removed byte ranges, in order, from the repeated windows."""
    if not windows.is_valid:
        return np.zeros((0, 2), np.int64)
    listed = windows.values
    runs = listed.field(1)
    sizes = np.diff(runs.offsets.to_numpy())
    edges = runs.flatten().to_numpy().astype(np.int64) + np.repeat(listed.field(0).to_numpy(), sizes)
    starts, ends = edges[::2], edges[1::2] + length - 1
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)
    return np.stack([starts[new], reach[last]], 1)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row ``doc_id, kept`` (the remaining bytes), ``spans`` (removed ranges, flat) and
    ``n_bytes``. Null and empty texts keep no bytes; repeated rows of ``length`` bytes or
    more lose all of them; an empty table gives no rows."""
    if length < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes are searched")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            kept, spans = [], []
            for i in range(batch.num_rows):
                text = _unpacked(batch["packed"][i].as_py(), batch["size"][i].as_py())
                cut = _spans(batch["windows"][i], length)
                edges = [0, *cut.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append(cut.ravel())
            yield batch["doc_id"], kept, spans, batch["size"]

    return map_arrow(_cut(docs, length), run, "doc_id long, kept binary, spans array<long>, n_bytes long")


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return remove_repeats(docs, length).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
