"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Words are counted over all training texts. The model predicts one of the ``classes`` most
frequent words, the end, or any rarer word as one class, from the two tokens before; within
the rare class words share its probability by their smoothed counts. So probabilities of all
tokens, one unseen word included, sum to one.

Training covers every training text: in each round all partitions start from the same
parameters, run noise-contrastive steps over their own tokens in numpy, and the parameters
are averaged by their tokens. Normalisers of all contexts, of which there are at most
(classes + 3) squared, come from batched matrix products.

Tasks hold the counts of the ``Settings.head`` most frequent words, a fixed number. Counts
of all other words are joined to the texts that hold them, so vocabularies of any size are
counted exactly.

After the count texts are split into words once more and stored as numbers, from which all
rounds and the scores are taken. Rounds start their random numbers by partition and average
over partitions, so the parameters depend on how the table is split, within the noise of the
estimation; counts and base scores do not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.session import stored

from .tables import map_arrow, texts


class Settings(NamedTuple):
    classes: int = 500  #: most frequent words that are classes of their own
    head: int = 200_000  #: most frequent words whose counts every task holds
    width: int = 24  #: length of word vectors
    noise: int = 64  #: noise words of a step, shared by its tokens
    batch: int = 2048  #: tokens of a step
    rounds: int = 2
    rate: float = 0.1


RARE, END = 0, 1
#: Distinct words that a task counts before it hands the counts on.
COUNTED = 300_000


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z as small letters."""
    return text.encode().lower().split()


class Counts(NamedTuple):
    table: DataFrame  #: ``word, held`` of all training words
    tokens: int  #: all training tokens, ends included
    distinct: int  #: distinct ones, the end included
    ends: int
    head: dict[bytes, int]  #: place of each frequent word, most frequent first
    held: np.ndarray  #: their counts


def count_words(docs: DataFrame, settings: Settings = Settings()) -> Counts:
    """Counts over all texts. Null and empty texts hold just an end."""

    def count(batches: Iterator[pa.RecordBatch]):
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                held.update(words(text))
                if len(held) >= COUNTED:
                    yield list(held), list(held.values())
                    held.clear()
        yield list(held), list(held.values())

    parts = map_arrow(texts(docs), count, "word binary, held long")
    table = stored(parts.groupBy("word").agg(F.sum("held").alias("held")), "word-counts")
    ends = docs.count()
    total, distinct = table.agg(F.coalesce(F.sum("held"), F.lit(0)), F.count("*")).first()
    top = _frequent(table, settings).collect()
    top.sort(key=lambda r: (-r[1], bytes(r[0])))
    head = {bytes(word): i for i, (word, _) in enumerate(top)}
    held = np.array([n for _, n in top], np.int64)
    return Counts(table, total + ends, distinct + (ends > 0), ends, head, held)


def _frequent(table: DataFrame, settings: Settings) -> DataFrame:
    """The most frequent words, at most ``head``: all above a count, found from a histogram.

    Only where words of the largest counts alone are too many, the first by their bytes.
    """
    reached, least = 0, None
    for held, n in table.groupBy("held").count().orderBy(F.desc("held")).toLocalIterator():
        if reached + n > settings.head:
            break
        reached, least = reached + n, held
    if reached < settings.classes and least != 1:
        return table.orderBy(F.desc("held"), "word").limit(settings.classes)
    return table.where(F.col("held") >= (least or 1))


class Model(NamedTuple):
    context: np.ndarray  #: vectors of the token before, a row per class and one for the start
    mix: np.ndarray  #: weights of the two context places
    target: np.ndarray
    bias: np.ndarray


#: A text as numbers: places of its words in the head (32 bits each, -1 outside) and the
#: words outside with their times.
_NUMBERED = "row long, doc_id long, training boolean, places binary, words array<binary>, times array<int>"


def numbered(docs: DataFrame, counts: Counts, training: Column | None = None) -> DataFrame:
    """A stored table of all texts as numbers (``_NUMBERED``), with a number for every row."""
    head = counts.head
    chosen = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    # Columns of ``docs`` may be named like these.
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), chosen.alias("training"))

    def run(batches: Iterator[pa.RecordBatch]):
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            listed = [words(t) for t in batch["text"].to_pylist()]
            edge = np.cumsum([0] + [len(w) for w in listed])
            place = np.fromiter(map(head.get, chain.from_iterable(listed), repeat(-1)), np.int32, int(edge[-1]))
            outside = place < 0
            tails = [Counter(compress(w, outside[a:b])) if outside[a:b].any() else {} for w, a, b in zip(listed, edge, edge[1:])]
            rows = (part << 33) + row + np.arange(len(listed))
            row += len(listed)
            yield (
                rows, batch["doc_id"], batch["training"], [place[a:b].tobytes() for a, b in zip(edge, edge[1:])],
                [list(t) for t in tails], [list(t.values()) for t in tails],
            )

    return stored(map_arrow(given, run, _NUMBERED), "numbered-texts")


def _tokens(places: list[bytes], classes: int) -> tuple[np.ndarray, ...]:
    """Head places of all words; classes of all tokens (ends included) and of the two before."""
    lengths = np.array([len(p) // 4 for p in places], np.int64)
    place = np.frombuffer(b"".join(places), np.int32)
    ends = np.cumsum(lengths + 1) - 1
    token = np.full(len(place) + len(places), END, np.int64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = np.where((place >= 0) & (place < classes), place + 2, RARE)
    starts = ends - lengths
    start = classes + 2
    one = np.append(start, token[:-1])
    one[starts] = start
    two = np.append(start, one[:-1])
    two[starts] = start
    return place, lengths, token, one, two


def _add_rows(to: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    to[rows[first]] += np.add.reduceat(values[order], first, axis=0)


class _Trainer:
    """Noise-contrastive steps with per-parameter step sizes."""

    def __init__(self, model: Model, noise: np.ndarray, settings: Settings, seed: int):
        self.model = Model(*(p.astype(np.float32) for p in model))
        self._sums = [np.full(p.shape, 1e-2, np.float32) for p in self.model]
        self._settings = settings
        self._rng = np.random.default_rng(seed)
        self._steps = np.cumsum(noise)
        self._log_noise = np.log(noise * settings.noise).astype(np.float32)

    def step(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        context, mix, target, bias = self.model
        drawn = np.searchsorted(self._steps, self._rng.random(self._settings.noise) * self._steps[-1])
        drawn = np.minimum(drawn, len(bias) - 1)
        before = context[one], context[two]
        expected = before[0] * mix[0] + before[1] * mix[1]
        true = (expected * target[token]).sum(1) + bias[token] - self._log_noise[token]
        miss = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        false = expected @ target[drawn].T + (bias[drawn] - self._log_noise[drawn])
        taken = 1 / (1 + np.exp(-np.clip(false, -30, 30)))
        to_expected = miss[:, None] * target[token] - taken @ target[drawn]
        slopes = [np.zeros_like(p) for p in self.model]
        _add_rows(slopes[0], one, to_expected * mix[0])
        _add_rows(slopes[0], two, to_expected * mix[1])
        slopes[1][0], slopes[1][1] = (to_expected * before[0]).sum(0), (to_expected * before[1]).sum(0)
        _add_rows(slopes[2], token, miss[:, None] * expected)
        np.subtract.at(slopes[2], drawn, taken.T @ expected)
        slopes[3] += np.bincount(token, miss, len(bias)).astype(np.float32)
        slopes[3] -= np.bincount(drawn, taken.sum(0), len(bias)).astype(np.float32)
        for p, s, slope in zip(self.model, self._sums, slopes):
            slope /= len(token)
            s += slope * slope
            p += self._settings.rate * slope / np.sqrt(s)


def fit(docs: DataFrame, counts: Counts, settings: Settings = Settings()) -> Model:
    """Train on all texts of ``docs`` by averaged rounds. Without texts the start is kept."""
    return _fit(numbered(docs, counts), counts, settings)


def _fit(table: DataFrame, counts: Counts, settings: Settings) -> Model:
    """Train on the training rows of texts as numbers."""
    classes = min(settings.classes, len(counts.head))
    size = classes + 2
    unigram = np.zeros(size)
    unigram[2:] = counts.held[:classes]
    unigram[END] = counts.ends
    unigram[RARE] = counts.tokens - unigram.sum()
    unigram = (unigram + 1) / (unigram + 1).sum()
    rng = np.random.default_rng(3)
    model = Model(
        rng.normal(0, 0.1, (size + 1, settings.width)),
        np.ones((2, settings.width)),
        rng.normal(0, 0.1, (size, settings.width)),
        np.log(unigram),
    )
    shapes = [p.shape for p in model]
    given = table.where("training").select("places")

    for round_ in range(settings.rounds):

        def learn(batches: Iterator[pa.RecordBatch], start: Model = model, round_: int = round_):
            part = TaskContext.get().partitionId()
            trainer, seen = _Trainer(start, unigram, settings, part * settings.rounds + round_), 0
            for batch in batches:
                _, _, *tokens = _tokens(batch["places"].to_pylist(), classes)
                order = trainer._rng.permutation(len(tokens[0]))
                for at in range(0, len(order), settings.batch):
                    chosen = order[at : at + settings.batch]
                    trainer.step(*(t[chosen] for t in tokens))
                seen += len(order)
            if seen:
                flat = np.concatenate([p.ravel() for p in trainer.model]).astype(float)
                yield [part], [seen], [(flat * seen).tobytes()]

        def add(batches: Iterator[pa.RecordBatch]):
            seen, total = 0, 0.0
            for batch in batches:
                for n, part in zip(batch["seen"].to_pylist(), batch["sums"].to_pylist()):
                    seen, total = seen + n, total + np.frombuffer(part)
            if seen:
                yield [0], [seen], [total.tobytes()]

        schema = "part int, seen long, sums binary"
        learnt = map_arrow(given, learn, schema).repartition(8, "part")
        sums = map_arrow(learnt, add, schema).collect()
        if sums:
            flat = sum(np.frombuffer(r[2]) for r in sums) / sum(r[1] for r in sums)
            cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
            model = Model(*(p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes)))
    return model


def normalisers(model: Model) -> np.ndarray:
    """Logarithm of the sum over all classes, for every pair of tokens before."""
    context, mix, target, bias = (p.astype(np.float32) for p in model)
    out = np.empty((len(context), len(context)), np.float32)
    for i, vector in enumerate(context):
        logits = (vector * mix[0] + context * mix[1]) @ target.T + bias
        top = logits.max(1, keepdims=True)
        out[i] = (top + np.log(np.exp(logits - top).sum(1, keepdims=True)))[:, 0]
    return out


def score(docs: DataFrame, counts: Counts, model: Model, settings: Settings = Settings()) -> DataFrame:
    """Per row ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``n_known`` counts tokens seen in training; ``base_score`` is the add-one unigram and
    ``score`` the model's log10 probability of the whole text with its end. Null and empty
    texts are an end alone; repeated rows score alike. Without any training text every word
    is unseen.
    """
    return _score(numbered(docs, counts), counts, model)


def _score(table: DataFrame, counts: Counts, model: Model) -> DataFrame:
    """Scores of texts as numbers."""
    classes = len(model.bias) - 2
    norm = normalisers(model)
    single = Model(*(p.astype(np.float32) for p in model))
    ends, log_held = int(counts.ends > 0), np.log10(counts.held + 1.0)
    rare_tokens = counts.tokens - counts.ends - int(counts.held[:classes].sum())
    rare_words = counts.distinct - ends - classes
    log_rare = np.log10(rare_tokens + rare_words + 1)
    log_all = np.log10(counts.tokens + counts.distinct + 1)
    log_ends = np.log10(counts.ends + 1)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            place, lengths, token, one, two = _tokens(batch["places"].to_pylist(), classes)
            logp = np.empty(len(token))
            for at in range(0, len(token), 1 << 15):
                p = slice(at, at + (1 << 15))
                expected = single.context[one[p]] * single.mix[0] + single.context[two[p]] * single.mix[1]
                logp[p] = (expected * single.target[token[p]]).sum(1) + single.bias[token[p]] - norm[one[p], two[p]]
            starts = np.cumsum(lengths + 1) - lengths - 1
            by_class = np.add.reduceat(logp, starts) / np.log(10) if len(starts) else logp
            known = place >= 0
            held = np.where(known, log_held[np.where(known, place, 0)], 0.0) if len(log_held) else np.zeros(len(place))
            edge = np.append(0, np.cumsum(lengths))
            upto = lambda x: np.diff(np.append(0.0, np.cumsum(x))[edge])
            rare = (place < 0) | (place >= classes)
            base = upto(held) + log_ends - (lengths + 1) * log_all
            rough = by_class + upto(held * rare) - upto(rare) * log_rare
            n_known = np.round(upto(known)).astype(np.int64) + ends
            yield batch["row"], batch["doc_id"], lengths + 1, n_known, base, rough

    schema = "row long, doc_id long, n_tokens long, n_known long, base double, rough double"
    own = map_arrow(table.select("row", "doc_id", "places"), run, schema)
    tail = table.select("row", F.inline(F.arrays_zip("words", "times"))).withColumnRenamed("words", "word")
    least = int(counts.held[-1]) if len(counts.held) else 0
    rest = tail.join(counts.table.where(F.col("held") <= least), "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("held") + 1)).alias("log_rest"),
        F.sum("times").alias("known_rest"),
    )
    or_none = lambda name: F.coalesce(F.col(name), F.lit(0))
    return own.join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + or_none("known_rest")).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + or_none("log_rest")).alias("base_score"),
        (F.col("rough") + or_none("log_rest")).alias("score"),
    )


def fit_and_score(docs: DataFrame, training: Column, settings: Settings = Settings()) -> DataFrame:
    """Learn from the rows of ``docs`` that ``training`` holds for, score all."""
    chosen = docs.where(training)
    counts = count_words(chosen, settings)
    table = numbered(docs, counts, training)
    return _score(table, counts, _fit(table, counts, settings))
