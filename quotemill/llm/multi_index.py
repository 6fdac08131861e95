"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut into two halves, each quantised by a codebook of its own; a pair of
centroids names a cell. For a query, a heap yields cells in ascending order of the two
halves' summed distance until enough entries are reached; those are ranked by their exact
cosine.

Codebooks are fitted on at most ``Settings.sample`` vectors (the first by a hash of their
ids); every vector is indexed. Entries are held as blocks of bounded size, also where many
vectors share a cell, and of equal vectors only as many as an answer can name are kept, the
smallest ids first. The table of cell sizes has at most ``most_codes`` squared rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotemill.session import stored

from .tables import map_arrow


class Settings(NamedTuple):
    sample: int = 20_000  #: vectors that fit the codebooks
    per_cell: int = 25  #: entries of a cell, on average, that the codebooks aim at
    most_codes: int = 512  #: centroids of one half
    rounds: int = 12  #: k-means passes
    candidates: int = 6_000  #: entries at least that a query ranks, and
    share: float = 0.45  #: the share of all entries at least; data without clusters need much
    block: int = 1024  #: entries or queries of a cell in one row


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of vectors that can take part, each once.

    Null vectors, those with a null or non-finite component, zero vectors, rows without an
    id and vectors of another length than the most frequent one take no part.
    """
    part = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = part.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)).distinct()
    common = part.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return part.where(F.size("embedding") == (common[0] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _apart(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)[None, :]


def codebook(x: np.ndarray, size: int, rounds: int) -> np.ndarray:
    """k-means; a centroid that loses all its rows moves to the row farthest from its own."""
    rng = np.random.default_rng(11)
    distinct = np.unique(x, axis=0)
    codes = distinct[rng.permutation(len(distinct))[:size]]
    for _ in range(rounds):
        far = _apart(x, codes)
        own = far.argmin(1)
        held = np.bincount(own, minlength=len(codes))
        sums = np.stack([np.bincount(own, x[:, d], len(codes)) for d in range(x.shape[1])], 1)
        codes = np.where(held[:, None] > 0, sums / np.maximum(1, held)[:, None], codes)
        empty = np.flatnonzero(held == 0)
        codes[empty] = x[np.argsort(-far[np.arange(len(x)), own])[: len(empty)]]
    return codes


def traverse(first: np.ndarray, second: np.ndarray, held: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Cells (centroid pairs) that hold entries, nearest first, until ``wanted`` entries are reached.

    ``first`` and ``second`` are the distances to the halves' centroids and ``held`` the
    entries per pair. A heap holds the border of the pairs seen so far.
    """
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    near, other = first[one], second[two]
    heap, reached, cells = [(near[0] + other[0], 0, 0)], 0, []
    width = len(second)
    while heap and reached < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(one[i]), int(two[j])
        if held[cell]:
            cells.append(cell)
            reached += int(held[cell])
        if i + 1 < len(near):
            heapq.heappush(heap, (near[i + 1] + other[j], i + 1, j))
        if i == 0 and j + 1 < width:
            heapq.heappush(heap, (near[0] + other[j + 1], 0, j + 1))
    return cells


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, reached: np.ndarray, k: int):
    """Per query its ``k`` nearest of the entries it reached: query id, entry id, cosine."""
    sizes = np.sqrt((queries * queries).sum(1)), np.sqrt((vectors * vectors).sum(1))
    rough = (queries @ vectors.T) / sizes[0][:, None] / sizes[1][None, :]
    rough[(query_ids[:, None] == ids[None, :]) | ~reached] = -np.inf
    if len(ids) > k:
        least = np.partition(rough, -k, axis=1)[:, -k]
    else:
        least = np.full(len(query_ids), -1.0)
    q, e = np.nonzero((rough >= least[:, None] - 1e-9) & (rough > -np.inf))
    # Products are summed again pair by pair, so that equal vectors get equal figures.
    exact = (queries[q] * vectors[e]).sum(1) / (sizes[0][q] * sizes[1][e])
    order = np.lexsort((ids[e], -exact, q))
    q, e, exact = q[order], e[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return query_ids[q[keep]], ids[e[keep]], exact[keep]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by cosine for each query.

    Both tables have ``vec_id`` and ``embedding``. A query's own id is no candidate. Equal
    scores rank the smaller id first; fewer candidates give fewer rows; an empty table
    gives none.
    """
    whole = stored(usable(vectors), "vectors")
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    asked = stored(whole.join(asked, "vec_id", "left_semi"), "queries")
    same = Window.partitionBy("embedding").orderBy("vec_id")
    entries = whole.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n")
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).toArrow()
    x = _matrix(sample["embedding"].combine_chunks()) if sample.num_rows else np.ones((1, 2))
    x = _unit(x)
    middle = (x.shape[1] + 1) // 2
    total = whole.count()
    size = int(np.clip(np.sqrt(total / settings.per_cell), 1, settings.most_codes))
    one = codebook(x[:, :middle], size, settings.rounds)
    two = codebook(x[:, middle:], size, settings.rounds) if x.shape[1] > 1 else np.zeros((1, 0))

    def assign(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = _unit(_matrix(batch["embedding"])) if batch.num_rows else np.zeros((0, x.shape[1]))
            near = _apart(rows[:, :middle], one).argmin(1), _apart(rows[:, middle:], two).argmin(1)
            yield batch["vec_id"], batch["embedding"], *near

    schema = "vec_id long, embedding array<double>, first int, second int"
    index = stored(map_arrow(entries, assign, schema), "index")
    held = np.zeros((len(one), len(two)), np.int64)
    for first, second, count in index.groupBy("first", "second").count().collect():
        held[first, second] = count
    wanted = max(settings.candidates, int(np.ceil(settings.share * held.sum())))

    def probe(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = _unit(_matrix(batch["embedding"])) if batch.num_rows else np.zeros((0, x.shape[1]))
            ids, asked_, firsts, seconds = [], [], [], []
            distances = _apart(rows[:, :middle], one), _apart(rows[:, middle:], two)
            for n, (a, b) in enumerate(zip(*distances)):
                reached: dict[int, list[int]] = {}
                for first, second in traverse(a, b, held, wanted):
                    reached.setdefault(first, []).append(second)
                ids += [batch["vec_id"][n].as_py()] * len(reached)
                asked_ += [batch["embedding"][n].values.to_numpy()] * len(reached)
                firsts += reached
                seconds += reached.values()
            yield ids, asked_, firsts, seconds

    schema = "query_id long, query array<double>, first int, seconds array<int>"
    probes = stored(map_arrow(asked, probe, schema), "probes")

    def blocks(rows: DataFrame, key: str, name: str) -> DataFrame:
        """Rows of one first centroid in lists of bounded size."""
        counts = rows.groupBy("first").agg(F.count("*").alias("held"))
        block = F.pmod(F.xxhash64(key), F.ceil(F.col("held") / settings.block))
        dealt = rows.join(F.broadcast(counts), "first").groupBy("first", block.alias("block"))
        listed = F.struct(*[c for c in rows.columns if c != "first"])
        return dealt.agg(F.collect_list(listed).alias(name)).drop("block")

    left, right = blocks(probes, "query_id", "asked"), blocks(index, "vec_id", "entries")

    def rank(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                some, these = batch["asked"][i].values, batch["entries"][i].values
                reached = np.zeros((len(some), len(two)), bool)
                for n, seconds in enumerate(some.field(2)):
                    reached[n, seconds.values.to_numpy()] = True
                yield _best(
                    some.field(0).to_numpy(), _matrix(some.field(1)),
                    these.field(0).to_numpy(), _matrix(these.field(1)),
                    reached[:, these.field(2).to_numpy()], k,
                )

    found = map_arrow(left.join(right, "first").select("asked", "entries"), rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
