"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Distinct fingerprints are laid out by the population counts of their four 16-bit quarters.
Two fingerprints at distance r differ by at most r in the sum of these counts' differences,
so a tile is compared only with tiles whose counts lie within the radius; the comparison of
two tiles is an exclusive-or and a bit count of all pairs in numpy. A count signature with
many fingerprints is split into several tiles of bounded size by a hash.

Two tiles give a spanning forest of their links, never all pairs; components of the whole
follow by star operations over the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotemill.session import stored

from .components import components
from .tables import map_arrow, texts

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints of one tile, on average at most.
TILE = 2048

_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the 64-bit hashes have set."""
    n = len(hashes)
    blocks = -(-n // 255)
    padded = np.zeros(blocks * 255, np.uint64)
    padded[:n] = hashes
    # Eight byte lanes count one bit each; 255 values cannot overflow a lane.
    lanes = ((padded >> _SHIFTS) & _LANES).reshape(8, blocks, 255).sum(2, dtype=np.uint64)
    counts = lanes.view(np.uint8).reshape(8, blocks, 8).sum(1, dtype=np.int64)
    set_ = (counts.T.ravel() * 2 > n).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text's word shingles; 0 without any word.

    A-Z count as small letters; words end at ASCII white space. A text with fewer words than
    a shingle has one shingle of all its words.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends]
    hashed, least = xxhash.xxh64_intdigest, min(shingle, len(words))
    spans = zip(starts, ends[least - 1 :])
    return majority(np.array([hashed(joined[a : b - 1], SEED) for a, b in spans], np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` per row, ``fp`` as a signed long; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch["text"].to_pylist()]
            yield batch["doc_id"], np.array(found, np.uint64).view(np.int64)

    return map_arrow(texts(docs), run, "doc_id long, fp long")


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect whatever is linked between two tiles: (value, smaller root)."""
    values = np.concatenate([left, right])
    rows, columns = [], []
    block = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), block):
        apart = np.bitwise_count(left[at : at + block, None] ^ right[None, :])
        i, j = np.nonzero(apart <= radius)
        rows.append(i + at)
        columns.append(j + len(left))
    a, b = np.concatenate(rows), np.concatenate(columns)
    keep = values[a] != values[b]
    a, b = a[keep], b[keep]
    if not len(a):
        return a.astype(np.uint64), a.astype(np.uint64)
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    member = np.unique(np.concatenate([a, b]))
    member = member[label[member] != member]
    return values[member], values[label[member]]


def _nearby(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each opposite pair."""
    return [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``u, v``: edges that connect all fingerprints at most ``radius`` bits apart.

    ``distinct`` holds each fingerprint (``fp``) once. The table of signature sizes has at
    most 17^4 rows, which bounds its broadcast.
    """
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int") for k in range(4)]
    code = lambda parts: sum((p * 17**k for k, p in enumerate(parts)), F.lit(0))
    cells = distinct.select("fp", F.array(*quarters).alias("quarters"), code(quarters).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("held"))
    tile = F.pmod(F.xxhash64("fp"), F.ceil(F.col("held") / TILE))
    tiles = (
        cells.join(F.broadcast(sizes), "cell")
        .groupBy("cell", tile.alias("tile"))
        .agg(F.first("quarters").alias("quarters"), F.collect_list("fp").alias("fps"))
    )
    steps = []
    for d in _nearby(radius):
        moved = [F.col("quarters")[k] + F.lit(x) for k, x in enumerate(d)]
        inside = F.array_min(F.array(*moved)).between(0, 16) & F.array_max(F.array(*moved)).between(0, 16)
        steps.append(F.when(inside, code(moved)))
    left = tiles.select(
        F.col("cell").alias("own"), F.col("tile").alias("own_tile"), F.col("fps").alias("left_fps"),
        F.explode(F.array_compact(F.array(*steps))).alias("cell"),
    )
    right = tiles.select("cell", "tile", F.col("fps").alias("right_fps"))
    pairs = left.join(right, "cell").where("own <> cell OR own_tile <= tile").select("left_fps", "right_fps")

    def compare(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for a, b in zip(batch["left_fps"], batch["right_fps"]):
                one, other = (x.values.to_numpy().view(np.uint64) for x in (a, b))
                u, v = forest(one, other, radius)
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
            yield np.concatenate(us), np.concatenate(vs)

    return map_arrow(pairs, compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per input row ``doc_id, fp, component_id``.

    Rows whose fingerprints are linked, directly or over others, share the smallest
    ``doc_id`` among them (null if none has one). Rows without words have fingerprint 0 and
    are linked like any other. Repeated rows fall together; an empty table gives no rows.
    """
    own = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = found.join(distinct, "fp")
    roots = named.groupBy("root").agg(F.min("least").alias("shared"))
    shared = named.join(roots, "root").select("fp", "shared")
    ids = distinct.join(shared, "fp", "left").select("fp", F.coalesce("shared", "least").alias("component_id"))
    return own.join(ids, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row per group: that of the smallest ``doc_id``, all columns kept.

    Of several rows with that id the one with the smallest text stays. Rows without an id
    cannot be told apart by one and stay as they are.
    """
    groups = near_duplicates(docs, shingle, radius)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    names = docs.columns
    at = names.index("doc_id")
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kept = kept.withColumnRenamed("doc_id", f"c{at}")
    order = Window.partitionBy(f"c{at}").orderBy(F.col(f"c{names.index('text')}").asc_nulls_first())
    one = plain.join(kept, f"c{at}", "left_semi").withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")
    return one.unionByName(plain.where(F.col(f"c{at}").isNull())).toDF(*names)
