"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the sets of hashed byte n-grams of the lower-cased text, with blanks for signs,
so that n-grams at the start of a word stand out. The log-count ratio of
each bucket is counted on labelled rows; buckets that say nothing are left out; a logistic
regression on the presence of the others, each scaled by its ratio, gives the score.

The fit reads at most ``Settings.sample`` labelled rows, the first by a hash of their ids.
That bounds what is broadcast and what reaches the driver; scoring reads every text once,
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import labelled, map_arrow, with_columns_of_text


class Settings(NamedTuple):
    sample: int = 16_000  #: labelled rows that the fit may read
    orders: tuple[int, ...] = (6, 7, 8)  #: lengths of n-grams in bytes, at most eight
    bits: int = 21  #: buckets as a power of two
    smoothing: float = 1.0
    least_rows: int = 4  #: rows that must hold a bucket
    least_ratio: float = 1.5  #: size of a log-count ratio that counts
    most_buckets: int = 20_000  #: buckets with the largest weight of evidence
    ridge: float = 1e-3
    steps: int = 150


class Model(NamedTuple):
    weights: np.ndarray  #: ratio times coefficient per bucket; zero for buckets left out
    bias: float
    settings: Settings


# Letters in lower case; digits and what is not ASCII stay; other bytes become blanks.
_PLAIN = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))
#: Bytes that are hashed at a time; longer texts are taken in overlapping pieces.
PIECE = 1 << 17


def _joined(batch: list[str], orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, apart by zeros that no n-gram can bridge; their starts."""
    gap = b"\0" * max(orders)
    parts = [gap + b" " + t.encode().translate(_PLAIN) + b" " for t in batch]
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]]) if parts else np.zeros(0, np.int64)
    return np.frombuffer(b"".join(parts) + gap, np.uint8), starts


def _buckets(data: np.ndarray, settings: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """Place of a piece and the bucket of the n-gram at each place, per order."""
    longest = max(settings.orders)
    for at in range(0, len(data), PIECE):
        piece = data[at : at + PIECE + longest - 1].astype(np.uint64)
        for order in settings.orders:
            n = min(len(piece) - order + 1, PIECE)
            if n <= 0:
                continue
            gram = np.full(n, order, np.uint64)
            for k in range(order):
                gram = (gram << np.uint64(8)) | piece[k : k + n]
            gram *= np.uint64(0x9E3779B97F4A7C15)
            yield at, (gram >> np.uint64(64 - settings.bits)).astype(np.int64)


def features(batch: list[str], settings: Settings, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of the chosen buckets (a mask), sorted."""
    data, starts = _joined(batch, settings.orders)
    found = []
    for at, buckets in _buckets(data, settings):
        places = np.flatnonzero(chosen[buckets])
        rows = np.searchsorted(starts, places + at, "right") - 1
        found.append((rows << settings.bits) | buckets[places])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> settings.bits, pairs & ((1 << settings.bits) - 1)


class _Distinct:
    """All distinct buckets of a text, in time linear in its length."""

    def __init__(self, settings: Settings):
        self._settings = settings
        self._seen = np.zeros(1 << settings.bits, bool)
        self._place = np.zeros(1 << settings.bits, np.int32)

    def of(self, text: str) -> np.ndarray:
        found = []
        for _, buckets in _buckets(_joined([text], self._settings.orders)[0], self._settings):
            new = buckets[~self._seen[buckets]]
            places = np.arange(len(new), dtype=np.int32)
            self._place[new] = places
            new = new[self._place[new] == places]
            self._seen[new] = True
            found.append(new)
        out = np.concatenate(found) if found else np.zeros(0, np.int64)
        self._seen[out] = False
        return out


def _counts(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Per class, the rows that hold each bucket."""
    size, width = 1 << settings.bits, 1 << 12

    def count(batches: Iterator[pa.RecordBatch]):
        total, distinct = np.zeros((2, size), np.int32), _Distinct(settings)
        for batch in batches:
            for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist()):
                total[int(label > 0), distinct.of(text)] += 1
        for chunk in range(size // width):
            part = total[:, chunk * width : (chunk + 1) * width]
            held = np.flatnonzero(part.any(0))
            if len(held):
                yield [chunk], [np.concatenate([held[None], part[:, held]]).astype("<i4").tobytes()]

    def add(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(batch["chunk"].to_pylist(), batch["part"].to_pylist()):
                held, *counts = np.frombuffer(part, "<i4").reshape(3, -1)
                sums.setdefault(chunk, np.zeros((2, width), "<i8"))[:, held] += counts
        for chunk, total in sums.items():
            yield [chunk], [total.tobytes()]

    schema = "chunk int, part binary"
    parts = map_arrow(rows, count, schema).repartition("chunk")
    total = np.zeros((2, size), np.int64)
    for chunk, part in map_arrow(parts, add, schema).collect():
        total[:, chunk * width : (chunk + 1) * width] = np.frombuffer(part, "<i8").reshape(2, width)
    return total[0], total[1]


def _logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, label: np.ndarray, width: int, settings: Settings):
    """Ridge logistic regression by Adam on whole passes; coefficients and bias."""
    n = len(label)
    weights, bias = np.full(width, 1e-2), 0.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, settings.steps + 1):
        margin = np.bincount(row, weights.astype(np.float32)[column] * value, n) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label) / n
        slope = np.bincount(column, error.astype(np.float32)[row] * value, width) + settings.ridge / n * weights
        slope = np.append(slope, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows (``doc_id, label``). Without rows of both classes every score is
    the share of label 1, or one half without any row."""
    rows = labelled(docs, labels, settings.sample)
    negative, positive = _counts(rows, settings)
    ratio = np.log((positive + settings.smoothing) / (positive + settings.smoothing).sum())
    ratio -= np.log((negative + settings.smoothing) / (negative + settings.smoothing).sum())
    usable = (np.abs(ratio) >= settings.least_ratio) & (positive + negative >= settings.least_rows)
    evidence = np.abs(ratio) * np.sqrt(positive + negative) * usable
    chosen = np.zeros(len(ratio), bool)
    chosen[np.argsort(-evidence, kind="stable")[: settings.most_buckets]] = True
    chosen &= usable
    del evidence, usable, negative, positive

    def pick(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            row, bucket = features(batch["text"].to_pylist(), settings, chosen)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield batch["label"], [bucket[a:b] for a, b in zip(cuts, cuts[1:])]

    picked = map_arrow(rows, pick, "label int, buckets array<int>").toArrow()
    label = np.array(picked["label"].to_pylist(), float)
    weights = np.zeros(len(ratio))
    if len(label) == 0 or label.min() == label.max():
        share = np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3)
        return Model(weights.astype(np.float32), float(np.log(share / (1 - share))), settings)
    lists = picked["buckets"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    # Small types: these arrays have one cell per feature of every sampled row.
    row = np.repeat(np.arange(len(label), dtype=np.int32), lengths)
    names = np.flatnonzero(chosen)
    place = np.zeros(len(ratio), np.int32)
    place[names] = np.arange(len(names))
    column = place[lists.flatten().to_numpy()]
    value = ratio[names].astype(np.float32)[column]
    del picked, lists, place
    coefficients, bias = _logistic(row, column, value, label, len(names), settings)
    weights[names] = coefficients * ratio[names]
    return Model(weights.astype(np.float32), bias, settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``score`` (0 to 1) of every whole text.

    Null and empty texts get the score of a text without any known n-gram. A column named
    ``score`` is replaced.
    """
    known = model.weights != 0

    def run(batch: list[str]):
        row, bucket = features(batch, model.settings, known)
        margin = np.bincount(row, model.weights[bucket], len(batch)) + model.bias
        return [1 / (1 + np.exp(-np.clip(margin, -30, 30)))]

    return with_columns_of_text(docs, run, "score double")
