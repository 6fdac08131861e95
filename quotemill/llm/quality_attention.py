"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of fixed length. Each passage is described by the shares of
its byte classes and hashed byte trigrams and by how much it repeats itself, and encoded by one hidden layer. Gated attention
(a tanh part times a sigmoid part) weighs the passages; weights and encoder are learned
from document labels alone, and the logistic score is that of the weighted mean of the
encoded passages.

The fit reads at most ``Settings.sample`` labelled rows, the first by a hash of their ids.
Scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from .tables import labelled, map_arrow, with_columns_of_text


class Settings(NamedTuple):
    sample: int = 4_000  #: labelled rows that the fit may read
    passage: int = 512  #: bytes of a passage
    hidden: int = 24
    gate: int = 12
    epochs: int = 12
    rate: float = 0.01
    decay: float = 1e-4


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    settings: Settings


CLASSES, TRIGRAMS = 64, 128
REPEATS, LONG_GRAMS = 3, 1024
WIDTH = CLASSES + TRIGRAMS + REPEATS
#: Passages that are counted at a time; longer texts are taken in slices.
SLICE = 2048


def _byte_classes() -> np.ndarray:
    """Small letters, capitals as one class, digits as one, each ASCII sign by itself."""
    out = np.zeros(256, np.int64)
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        if chr(b).islower() and b < 128:
            out[b] = b - ord("a")
        elif chr(b).isupper() and b < 128:
            out[b] = 26
        elif chr(b).isdigit() and b < 128:
            out[b] = 27
        elif b in signs:
            out[b] = 28 + signs.index(b)
        elif b in (9, 10, 13, 32):
            out[b] = 61
        else:
            out[b] = 62 if b >= 128 else 63
    return out


_CLASS_OF = _byte_classes()


def _count(slices: list[bytes], size: int) -> np.ndarray:
    """Feature rows of consecutive passages of some slices."""
    lengths = np.array([len(s) for s in slices])
    data = np.frombuffer(b"".join(slices) + b"\0\0", np.uint8)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    pieces = np.maximum(1, -(-lengths // size))
    first = np.cumsum(pieces) - pieces
    row = np.repeat(first, lengths) + inside // size
    total = int(pieces.sum())
    wide = data.astype(np.int64)
    gram = (wide[:-2] * 961 + wide[1:-1] * 31 + wide[2:]) * 0x9E3779B1 >> 20 & (TRIGRAMS - 1)
    classes = np.bincount(row * CLASSES + _CLASS_OF[data[:-2]], minlength=total * CLASSES)
    grams = np.bincount(row * TRIGRAMS + gram, minlength=total * TRIGRAMS)
    counts = np.hstack([classes.reshape(total, CLASSES), grams.reshape(total, TRIGRAMS)])
    held = np.maximum(1, np.bincount(row, minlength=total))
    return np.hstack([counts / held[:, None], _repeats(wide[:-2], row, total, held)]).astype(np.float32)


def _repeats(wide: np.ndarray, row: np.ndarray, total: int, held: np.ndarray) -> np.ndarray:
    """Per passage: share of words like the word before, of words, and of distinct six-grams."""
    out = np.zeros((total, REPEATS))
    if len(wide) < 6:
        return out
    gram = np.zeros(len(wide) - 5, np.int64)
    for k in range(6):
        gram = gram * 31 + wide[k : k + len(gram)]
    gram = gram * 0x9E3779B1 >> 16 & (LONG_GRAMS - 1)
    seen = np.zeros(total * LONG_GRAMS, bool)
    seen[row[: len(gram)] * LONG_GRAMS + gram] = True
    out[:, 2] = seen.reshape(total, -1).sum(1) / held
    ink = wide > 32
    starts = np.flatnonzero(ink & ~np.append(False, ink[:-1]))
    if len(starts) < 2:
        return out
    inside = np.arange(starts[0], len(wide)) - np.repeat(starts, np.diff(np.append(starts, len(wide))))
    power = np.cumprod(np.append(1, np.full(63, 1_000_003)))
    word = np.add.reduceat((wide * ink)[starts[0] :] * power[np.minimum(inside, 63)], starts - starts[0])
    same = (word[1:] == word[:-1]) & (row[starts[1:]] == row[starts[:-1]])
    words = np.bincount(row[starts], minlength=total)
    out[:, 0] = np.bincount(row[starts[1:]][same], minlength=total) / np.maximum(1, words)
    out[:, 1] = words / held
    return out


def passages(batch: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of all texts, and each text's number of passages.

    An empty text is one passage of zeros. Every text ends with a line end of its own, so
    its features do not depend on its neighbours.
    """
    rows, numbers, held, waiting = [], [], 0, []
    for text in batch:
        data = text.encode()
        if data:
            data += b"\n\n"
        step = size * SLICE
        slices = [data[a : a + step] for a in range(0, len(data), step)] or [b""]
        numbers.append(sum(max(1, -(-len(s) // size)) for s in slices))
        for part in slices:
            waiting.append(part)
            held += len(part)
            if held >= step:
                rows.append(_count(waiting, size))
                held, waiting = 0, []
    if waiting:
        rows.append(_count(waiting, size))
    features = np.vstack(rows) if rows else np.zeros((0, WIDTH), np.float32)
    return features, np.array(numbers, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(features: np.ndarray, numbers: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Encoded passages, their attention, and the documents' scores."""
    starts = np.cumsum(numbers) - numbers
    bag = np.repeat(np.arange(len(numbers)), numbers)
    code = np.tanh(features @ w["encode"] + w["encode_bias"])
    left, right = np.tanh(code @ w["tanh"]), _sigmoid(code @ w["gate"])
    raw = (left * right) @ w["attend"]
    raw = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
    weight = raw / np.add.reduceat(raw, starts)[bag]
    mean = np.add.reduceat(code * weight[:, None], starts, axis=0)
    score = _sigmoid(mean @ w["out"] + w["out_bias"][0])
    return dict(starts=starts, bag=bag, code=code, left=left, right=right, weight=weight, mean=mean, score=score)


def _slopes(features: np.ndarray, numbers: np.ndarray, label: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss."""
    f = _forward(features, numbers, w)
    error = (f["score"] - label) / len(label)
    to_mean = error[:, None] * w["out"]
    from_bag = to_mean[f["bag"]]
    to_weight = (f["code"] * from_bag).sum(1)
    spread = np.add.reduceat(to_weight * f["weight"], f["starts"])[f["bag"]]
    to_raw = f["weight"] * (to_weight - spread)
    to_both = to_raw[:, None] * w["attend"]
    to_left = to_both * f["right"] * (1 - f["left"] ** 2)
    to_right = to_both * f["left"] * f["right"] * (1 - f["right"])
    to_code = from_bag * f["weight"][:, None] + to_left @ w["tanh"].T + to_right @ w["gate"].T
    to_code *= 1 - f["code"] ** 2
    return {
        "encode": features.T @ to_code,
        "encode_bias": to_code.sum(0),
        "tanh": f["code"].T @ to_left,
        "gate": f["code"].T @ to_right,
        "attend": (f["left"] * f["right"]).T @ to_raw,
        "out": f["mean"].T @ error,
        "out_bias": error.sum(keepdims=True),
    }


def train(features: np.ndarray, numbers: np.ndarray, label: np.ndarray, settings: Settings) -> Model:
    """Learn from bags of passages and their labels. Bags of one class only give a constant."""
    rng = np.random.default_rng(7)
    mean = features.mean(0) if len(features) else np.zeros(WIDTH, np.float32)
    scale = 1 / (features.std(0) + 1e-3) if len(features) else np.ones(WIDTH, np.float32)
    h, g = settings.hidden, settings.gate
    w = {
        "encode": rng.normal(0, 0.5 / np.sqrt(WIDTH), (WIDTH, h)),
        "encode_bias": np.zeros(h),
        "tanh": rng.normal(0, 1 / np.sqrt(h), (h, g)),
        "gate": rng.normal(0, 1 / np.sqrt(h), (h, g)),
        "attend": rng.normal(0, 1 / np.sqrt(g), g),
        "out": rng.normal(0, 1 / np.sqrt(h), h),
        "out_bias": np.zeros(1),
    }
    if len(label) == 0 or label.min() == label.max():
        share = np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3)
        w["out"], w["out_bias"] = np.zeros(h), np.log([share / (1 - share)])
        return Model(mean, scale, {k: v.astype(np.float32) for k, v in w.items()}, settings)
    scaled = (features - mean) * scale
    starts = np.cumsum(numbers) - numbers
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            rows = np.concatenate([np.arange(starts[i], starts[i] + numbers[i]) for i in chosen])
            slopes = _slopes(scaled[rows], numbers[chosen], label[chosen], w)
            step += 1
            for k, slope in slopes.items():
                slope = slope + settings.decay * w[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                size = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                w[k] = w[k] - settings.rate * first[k] / (1 - 0.9**step) / size
    return Model(mean, scale, {k: v.astype(np.float32) for k, v in w.items()}, settings)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of labelled rows (``doc_id, label``); see ``labelled``.

    Only the sample's passage features reach the driver, in half precision.
    """

    def describe(batches):
        for batch in batches:
            features, numbers = passages(batch["text"].to_pylist(), settings.passage)
            cuts = np.cumsum(numbers)
            parts = np.split(features.astype("<f2"), cuts[:-1])
            yield batch["doc_id"], batch["label"], [p.tobytes() for p in parts]

    rows = labelled(docs, labels, settings.sample)
    bags = map_arrow(rows, describe, "doc_id long, label int, passages binary").toArrow().sort_by("doc_id")
    data = [np.frombuffer(b, "<f2").reshape(-1, WIDTH) for b in bags["passages"].to_pylist()]
    numbers = np.array([len(d) for d in data], np.int64)
    features = np.vstack(data).astype(np.float32) if data else np.zeros((0, WIDTH), np.float32)
    return train(features, numbers, np.array(bags["label"].to_pylist(), float), settings)


def score_texts(batch: list[str], model: Model) -> np.ndarray:
    """Scores of a batch of texts."""
    if not batch:
        return np.zeros(0)
    features, numbers = passages(batch, model.settings.passage)
    return _forward((features - model.mean) * model.scale, numbers, model.weights)["score"].astype(float)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``score`` (0 to 1) of every whole text.

    Null and empty texts count as one passage without content. A column named ``score`` is
    replaced; repeated rows get the same score.
    """
    return with_columns_of_text(docs, lambda batch: [score_texts(batch, model)], "score double")
