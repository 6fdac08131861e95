"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases.

A phrase is ``window`` consecutive words of a benchmark item, or all words of a shorter one.
Every task builds FM-indexes over shards of its documents, searches all phrases backwards
through wavelet ranks, finds their places from sampled suffix positions, and merges the word
spans they cover. Words that no phrase holds end a run, and a row of them is one separator
in the index: no occurrence can reach across, so this loses none.

Documents are never shuffled. Phrases go to the tasks in blocks of at most ``BLOCK_WORDS``
words of items; a larger benchmark takes further passes, so what is broadcast is bounded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fm_index import FMIndex
from .tables import map_arrow

WINDOW = 10
#: Words of items in one pass, and positions of one shard's index.
BLOCK_WORDS = 500_000
SHARD = 1_000_000

_PLAIN = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words: letters, digits and whatever is not ASCII. Null has none."""
    return text.encode().translate(_PLAIN).split() if text else []


class Phrases(NamedTuple):
    symbols: dict[bytes, int]
    grid: np.ndarray  #: one distinct phrase a row
    lengths: np.ndarray
    items: list[list[str]]  #: ids of the items that hold each phrase


def phrases(items: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    """The distinct phrases of items (id, text). An item without words has none."""
    symbols: dict[bytes, int] = {}
    holders: dict[tuple[int, ...], dict[str, None]] = {}
    for item, text in items:
        ids = [symbols.setdefault(w, len(symbols) + 1) for w in words(text)]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            holder = holders.setdefault(tuple(ids[at : at + window]), {})
            if item is not None:
                holder[str(item)] = None
    grid = np.zeros((len(holders), window), np.int32)
    lengths = np.zeros(len(holders), np.int64)
    for i, phrase in enumerate(holders):
        grid[i, : len(phrase)] = phrase
        lengths[i] = len(phrase)
    return Phrases(symbols, grid, lengths, [list(h) for h in holders.values()])


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str | None]]]:
    """Items in blocks of bounded size; at least one block, perhaps empty."""
    block, held = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row[0], row[1]))
        held += len(words(row[1]))
        if held >= BLOCK_WORDS:
            yield block
            block, held = [], 0
    yield block


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered ranges of half-open spans; ranges that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


class _Shard:
    """Documents of one index, as runs of known words between separators."""

    def __init__(self, found: Phrases):
        self._phrases = found
        self._symbols: list[np.ndarray] = []
        self._places: list[np.ndarray] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, text: str | None) -> None:
        listed = words(text)
        ids = np.fromiter(map(self._phrases.symbols.get, listed, repeat(0)), np.int32, len(listed))
        ids = np.append(ids, np.int32(0))
        keep = np.flatnonzero((ids != 0) | (np.append(np.int32(0), ids[:-1]) != 0))
        self._symbols.append(ids[keep])
        self._places.append(keep.astype(np.int64))
        self.counts.append(len(listed))
        self.size += len(keep)

    def search(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word, end and phrase of every occurrence, by document."""
        symbols = np.concatenate(self._symbols) if self._symbols else np.zeros(0, np.int32)
        index = FMIndex(symbols)
        low, high = index.search(self._phrases.grid, self._phrases.lengths)
        count = high - low
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[phrase]
        at = index.locate(rows)
        bounds = np.cumsum([len(s) for s in self._symbols]) if self._symbols else np.zeros(0, np.int64)
        doc = np.searchsorted(bounds, at, "right")
        word = (np.concatenate(self._places) if self._places else at)[at]
        order = np.argsort(doc, kind="stable")
        doc, word, phrase = doc[order], word[order], phrase[order]
        return doc, word, word + self._phrases.lengths[phrase], phrase


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``hit_spans`` and ``hit_items``.

    ``hit_spans`` lists starts and ends (exclusive) of the merged runs of hit words, counted
    from 0, as start, end, start, end, …; ``hit_items`` the ids, as sorted texts, of items
    with an occurring phrase. Null and empty texts have no words; repeated rows are judged
    each by itself; an empty benchmark hits nothing. Columns of these names are replaced.
    """
    added = T.StructType.fromDDL("n_words long, hit_spans array<int>, hit_items array<string>")
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in added.names]
    names = [docs.columns[i] for i in kept]
    text = f"c{docs.columns.index('text')}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*[f"c{i}" for i in kept])
    out = plain.withColumns({
        "n_words": F.lit(0).cast("long"),
        "hit_spans": F.array().cast("array<int>"),
        "hit_items": F.array().cast("array<string>"),
    })
    for block in _blocks(benchmark):
        found = phrases(block, window)

        def run(batches: Iterator[pa.RecordBatch], found: Phrases = found):
            held: list[pa.RecordBatch] = []
            shard = _Shard(found)
            for batch in batches:
                at = 0
                for i, value in enumerate(batch[text]):
                    shard.add(value.as_py())
                    if shard.size >= SHARD:
                        held.append(batch.slice(at, i + 1 - at))
                        yield _results(pa.Table.from_batches(held).combine_chunks(), shard)
                        held, shard, at = [], _Shard(found), i + 1
                if at < batch.num_rows:
                    held.append(batch.slice(at))
            if held:
                yield _results(pa.Table.from_batches(held).combine_chunks(), shard)

        out = map_arrow(out, run, T.StructType(plain.schema.fields + added.fields))
    return out.toDF(*names, *added.names)


def _results(rows: pa.Table, shard: _Shard) -> list:
    """The shard's rows, with what was found before and now."""
    doc, start, end, phrase = shard.search()
    cuts = np.searchsorted(doc, np.arange(rows.num_rows + 1))
    spans, items = rows["hit_spans"].to_pylist(), rows["hit_items"].to_pylist()
    for i in np.unique(doc).tolist():
        a, b = cuts[i], cuts[i + 1]
        old = np.array(spans[i], np.int64).reshape(-1, 2)
        first, last = merged(np.append(old[:, 0], start[a:b]), np.append(old[:, 1], end[a:b]))
        spans[i] = np.stack([first, last], 1).ravel().tolist()
        hit = {name for p in np.unique(phrase[a:b]).tolist() for name in shard._phrases.items[p]}
        items[i] = sorted(hit.union(items[i]))
    kept = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns[:-3]]
    return [*kept, shard.counts, spans, items]


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    spans = F.col("hit_spans")
    n_hit = F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return find(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def _cut(text: str | None, spans: list[int]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not text or not spans:
        return text
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join(out) + text[at:]


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit spans cut from ``text``; columns and rows stay the same."""
    # What is found takes the place of columns of that name: the table's go under plain names.
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = find(docs.toDF(*at.values()).withColumnRenamed(at["text"], "text"), benchmark)
    cut = F.udf(_cut, "string")
    text = F.when(F.size("hit_spans") > 0, cut("text", "hit_spans")).otherwise(F.col("text"))
    return found.withColumn("text", text).drop("n_words", "hit_spans", "hit_items").toDF(*docs.columns)
