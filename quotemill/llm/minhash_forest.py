"""Near-duplicates by an LSH forest over MinHash signatures, links confirmed on full sets.

Every tree of the forest orders the documents by its own run of min-hashes, most
significant first. Documents that agree on the first ``DEPTH`` of them form a region, and a
region's depth adapts: where few documents share one min-hash less, these are the region
(``SPARSE``), so thinly settled parts of an order are searched wider.

1. Neighbours. Next to each other in an order are those with the longest common prefix.
   The neighbours of the first ``CHAINS`` orders are compared by their full sets, and the
   links give components: a large group of copies is joined by a linear number of pairs.
2. Rest. A region whose members are all in one component has nothing left to find. In every
   other region of every tree, members of different components are compared, in tiles of
   bounded rows and shingles, each pair in the first tree that brings it together: first
   signatures, which leave the members that have a partner worth a look, then these by
   their full sets. No partner is capped.

Two documents with a similarity of exactly 0.8 meet in no tree with probability
``(1 - 0.8 ** DEPTH) ** TREES`` (6e-7), less where regions are sparse. Signatures rule a
pair out below 71 of 120 agreements, 5.7 deviations under the 96 that 0.8 gives (1e-7).
Equal sets are one document from the start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import stored

from .components import components
from .tables import map_arrow, texts

SHINGLE, PERCENT = 4, 80
TREES, KEYS, DEPTH = 20, 6, 3
#: Documents of one min-hash less than ``DEPTH`` that still are one region.
SPARSE = 16
#: Orders whose neighbours are compared first.
CHAINS = 4
#: Agreements of a signature below which a pair is not looked at.
AGREE = 71
#: Rows and shingles of one tile.
TILE_ROWS, TILE_SHINGLES = 256, 1 << 18
#: Ids (8 bytes each) that may be broadcast.
BROADCAST_IDS = 1 << 20

_RNG = np.random.default_rng(7)
_FACTORS = _RNG.integers(1, 2**63, TREES * KEYS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, TREES * KEYS, np.uint64)
_BYTES = 2 * KEYS


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A-Z count as small letters; words end at ASCII white space. A text with fewer words than
    a shingle has one shingle of all its words, one without words has none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    least = min(size, len(words))
    hashed = xxhash.xxh3_64_intdigest
    spans = zip([0, *ends], ends[least - 1 :])
    return np.unique(np.array([hashed(joined[a : b - 1]) for a, b in spans], np.uint64))


def signature(found: np.ndarray) -> np.ndarray:
    """Sixteen bits of each min-hash of a set of hashes, tree after tree."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        block = found[at : at + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(least, block.min(0), out=least)
    return (least >> np.uint64(16)).astype(">u2")


def similar(one: int, other: int, common: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (one + other - common)


def _sets(docs: DataFrame) -> DataFrame:
    """``uid, doc_id, rid, n, sig, text`` per row; ``rid`` identifies the set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rids, sizes, sigs = [], [], []
            for text in batch["text"].to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                rids.append(xxhash.xxh3_128_digest(found.tobytes()))
                sigs.append(signature(found).tobytes() if len(found) else None)
            yield batch["doc_id"], rids, sizes, sigs, batch["text"]

    made = map_arrow(texts(docs), run, "doc_id long, rid binary, n long, sig binary, text string")
    return stored(made.withColumn("uid", F.monotonically_increasing_id()), "sets")


def _members(distinct: DataFrame) -> DataFrame:
    """``tree, region, uid, last`` of all documents that share a region.

    ``last`` is the neighbour in front, null for a region's first. A stretch that the border
    of a partition may have cut counts for both depths it may have.
    """
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    label = F.expr(f"substring(sig, tree * {_BYTES} + 1, {_BYTES})").alias("label")
    rows = distinct.select("uid", "sig", trees).select("tree", label, "uid")
    ordered = rows.repartitionByRange("tree", "label", "uid").sortWithinPartitions("tree", "label", "uid")
    short, full = 2 * (DEPTH - 1), 2 * DEPTH

    def regions(tree: int, run: list[tuple[bytes, int]], cut: bool, dense: bool):
        def region(prefix: bytes, members: list[int], border: bool):
            if len(members) > 1 or border:
                name = xxhash.xxh3_64_intdigest(bytes([len(prefix)]) + prefix, tree) - (1 << 63)
                for before, uid in zip([None, *members], members):
                    yield tree, name, uid, before

        if not dense:
            yield from region(run[0][0][:short], [u for _, u in run], cut)
        if dense or cut:
            at = 0
            while at < len(run):
                end = at
                while end < len(run) and run[end][0][:full] == run[at][0][:full]:
                    end += 1
                yield from region(run[at][0][:full], [u for _, u in run[at:end]], cut)
                at = end

    def walk(batches: Iterator[pa.RecordBatch]):
        # A stretch is flushed in blocks at full prefixes' ends, or it is held up to SPARSE rows.
        run, now, cut, dense = [], None, True, False
        for batch in batches:
            out = []
            for tree, label, uid in zip(*[batch[c].to_pylist() for c in ("tree", "label", "uid")]):
                key = (tree, label[:short])
                if key != now:
                    if run:
                        out.extend(regions(now[0], run, cut, dense))
                        cut = False
                    run, now, dense = [], key, False
                elif len(run) >= SPARSE and run[-1][0][:full] != label[:full]:
                    out.extend(regions(now[0], run, cut, True))
                    run, dense = [], True
                elif len(run) >= 4096:
                    # One region so far: its rows go out, the last one stays as the neighbour.
                    out.extend(regions(now[0], run, True, True))
                    run, dense = [run[-1]], True
                run.append((label, uid))
                dense = dense or len(run) > SPARSE
            if out:
                yield list(zip(*out))
        if run:
            out = list(regions(now[0], run, True, dense))
            if out:
                yield list(zip(*out))

    return stored(map_arrow(ordered, walk, "tree int, region long, uid long, last long"), "members")


def _named_texts(own: DataFrame, uids: DataFrame) -> DataFrame:
    """``uid, text`` of the documents named.

    Up to ``BROADCAST_IDS`` of them are sent to the texts; beyond that both sides are shuffled.
    """
    named = stored(uids.distinct(), "named")
    few = named.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return own.select("uid", "text").join(F.broadcast(named) if few else named, "uid", "left_semi")


def _confirmed(own: DataFrame, pairs: DataFrame) -> DataFrame:
    """``u, v`` of those pairs whose full sets are similar enough."""
    ends = pairs.select(F.col("u").alias("uid")).union(pairs.select(F.col("v").alias("uid")))
    found = stored(_named_texts(own, ends), "pair_texts")
    both = pairs.join(found.toDF("u", "one"), "u").join(found.toDF("v", "other"), "v")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = []
            for one, other in zip(batch["one"].to_pylist(), batch["other"].to_pylist()):
                a, b = shingles(one), shingles(other)
                keep.append(similar(len(a), len(b), len(np.intersect1d(a, b, True))))
            kept = pa.array(keep, pa.bool_())
            yield batch["u"].filter(kept), batch["v"].filter(kept)

    return map_arrow(both, run, "u long, v long")


def _agreements(left: np.ndarray, right: np.ndarray, tree: int) -> np.ndarray:
    """Agreeing min-hashes of every pair; 0 for pairs that an earlier tree brings together."""
    agree = np.zeros((len(left), len(right)), np.uint8)
    met = np.zeros(agree.shape, bool)
    for t in range(TREES):
        same = np.ones(agree.shape, bool)
        for k in range(t * KEYS, (t + 1) * KEYS):
            equal = left[:, k, None] == right[None, :, k]
            agree += equal
            if k < t * KEYS + DEPTH:
                same &= equal
        if t < tree:
            met |= same
    agree[met] = 0
    return agree


def _open(tree: int, sigs: np.ndarray, both: list[dict], cut: int) -> np.ndarray:
    """Which pairs between the first ``cut`` rows and the rest (0: within all) are to be compared."""
    left, right = (slice(cut), slice(cut, None)) if cut else (slice(None), slice(None))
    sizes, comps = (np.array([r[c] for r in both]) for c in ("n", "comp"))
    agree = _agreements(sigs[left], sigs[right], tree)
    one, other = sizes[left, None], sizes[None, right]
    ratio = 100 * np.minimum(one, other) >= PERCENT * np.maximum(one, other)
    return (agree >= AGREE) & ratio & (comps[left, None] != comps[None, right])


def _promising(tree: int, rows: list[dict], others: list[dict] | None) -> Iterator[tuple[int, int, int]]:
    """``tree, region, uid`` of rows whose signature allows a link to another component."""
    both = rows + (others or [])
    cut = len(rows) if others else 0
    found = _open(tree, np.array([np.frombuffer(r["sig"], ">u2") for r in both]), both, cut)
    for i in {*np.flatnonzero(found.any(1)), *(np.flatnonzero(found.any(0)) + cut)}:
        yield tree, both[i]["region"], both[i]["uid"]


def _links(tree: int, rows: list[dict], others: list[dict] | None) -> Iterator[tuple[int, int]]:
    """Links between two tiles (or within one) that join different components."""
    both = rows + (others or [])
    cut = len(rows) if others else 0
    sets = [shingles(r["text"]) for r in both]
    found = _open(tree, np.array([signature(x) for x in sets]), both, cut)
    sizes = [r["n"] for r in both]
    root = {r["comp"]: r["comp"] for r in both}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    needed = np.union1d(np.flatnonzero(found.any(1)), np.flatnonzero(found.any(0)) + cut)
    if not len(needed):
        return
    values, held = np.unique(np.concatenate([sets[i] for i in needed]), return_inverse=True)
    bits = np.zeros((len(both), -(-len(values) // 64) * 8), np.uint8)
    ends = np.cumsum([len(sets[i]) for i in needed])
    for i, part in zip(needed, np.split(held, ends[:-1])):
        np.bitwise_or.at(bits[i], part >> 3, np.left_shift(1, part & 7).astype(np.uint8))
    lanes = bits.view(np.uint64)
    for i in np.flatnonzero(found.any(1)):
        js = np.flatnonzero(found[i]) + cut
        mine = find(both[i]["comp"])
        js = np.array([j for j in js if j > i and find(both[j]["comp"]) != mine], np.int64)
        if not len(js):
            continue
        common = np.bitwise_count(lanes[i] & lanes[js]).sum(1)
        for j, c in zip(js, common):
            if similar(sizes[i], sizes[j], int(c)):
                a, b = find(both[i]["comp"]), find(both[j]["comp"])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    yield both[i]["uid"], both[j]["uid"]


def _compared(rows: DataFrame, material: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """``compare(tree, rows, others)`` over all tiles and pairs of tiles of all regions.

    ``rows`` has ``tree, region, uid, n, comp`` and should be stored, ``material`` what else
    a row needs by ``uid``. A region of one component is left out, one within the bounds is
    one tile.
    """
    key = ["tree", "region"]
    region = rows.groupBy(*key).agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows"), F.sum("n").alias("held")
    )
    small = (F.col("rows") <= TILE_ROWS) & (F.col("held") <= TILE_SHINGLES)
    # Similar sets differ in size by a quarter at most: neighbouring cells hold all partners.
    cell = F.when(small, -1).otherwise(F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int"))
    placed = rows.join(region.where("low < high"), key).select(*key, "uid", "n", "comp", cell.alias("cell"))
    placed = stored(placed, "open_regions")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = [found for r in batch.to_pylist() for found in compare(r["tree"], r["rows"], r.get("others"))]
            if out:
                yield list(zip(*out))

    def gathered(members: DataFrame, *by: str) -> DataFrame:
        row = F.struct("uid", "region", "comp", "n", *[c for c in material.columns if c != "uid"])
        return members.join(material, "uid").groupBy(*by).agg(F.collect_list(row).alias("rows"))

    lone = map_arrow(gathered(placed.where("cell < 0"), *key).select("tree", "rows"), run, schema)
    dense = placed.where("cell >= 0")
    if dense.isEmpty():
        return lone
    tiles = dense.groupBy(*key, "cell").agg(
        F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("n") / TILE_SHINGLES)).alias("tiles")
    )
    dealt = dense.join(tiles, [*key, "cell"]).withColumn("tile", F.pmod(F.xxhash64("uid"), "tiles"))
    tiled = stored(gathered(dealt, *key, "cell", "tile"), "tiles")
    left = tiled.withColumn("own", F.col("cell")).withColumn("cell", F.explode(F.array(F.col("cell"), F.col("cell") + 1)))
    right = tiled.select(*key, "cell", F.col("tile").alias("other"), F.col("rows").alias("others"))
    pairs = left.join(right, [*key, "cell"]).where("own < cell OR tile < other").select("tree", "rows", "others")
    return lone.union(map_arrow(tiled.select("tree", "rows"), run, schema)).union(map_arrow(pairs, run, schema))


def _rest(own: DataFrame, distinct: DataFrame, members: DataFrame, known: DataFrame) -> DataFrame:
    """``u, v``: links between components that regions still hold."""
    placed = members.select("tree", "region", "uid").distinct().join(known.toDF("uid", "root"), "uid", "left")
    placed = placed.join(distinct.select("uid", "n"), "uid").select("tree", "region", "uid", "n", F.coalesce("root", "uid").alias("comp"))
    placed = stored(placed, "placed")
    worth = _compared(placed, distinct.select("uid", "sig"), _promising, "tree int, region long, uid long")
    left = stored(placed.join(stored(worth, "promising").distinct(), ["tree", "region", "uid"], "left_semi"), "left")
    material = stored(_named_texts(own, left.select("uid")), "left_texts")
    return _compared(left, material, _links, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per input row ``doc_id, n_shingles, component_id``.

    Rows whose sets of four-word shingles are similar (0.8 or more), directly or over
    others, share the smallest ``doc_id`` among them (null if none has one). A null text or
    one without words has no shingle and is linked with nothing. Equal sets (repeated rows)
    fall together; columns other than ``doc_id`` and ``text`` are ignored; an empty table
    gives no rows.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    own = _sets(docs)
    distinct = stored(
        own.where("n > 0").groupBy("rid").agg(F.min("doc_id").alias("least"), F.min(F.struct("uid", "n", "sig")).alias("r"))
        .select("rid", "least", "r.uid", "r.n", "r.sig"), "distinct_sets",
    )
    members = _members(distinct)
    pairs = members.where(f"tree < {CHAINS} AND last IS NOT NULL AND last <> uid")
    pairs = stored(pairs.select(F.least("uid", "last").alias("u"), F.greatest("uid", "last").alias("v")).distinct(), "pairs")
    links = stored(_confirmed(own, pairs), "links")
    known = stored(components(links), "components")
    links = links.union(stored(_rest(own, distinct, members, known), "more_links"))
    found = components(links).withColumnRenamed("node", "uid")
    named = distinct.select("rid", "uid", "least").join(found, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    shared = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(shared, "root").select("rid", "component_id")
    rows = own.where("n > 0").select("doc_id", "rid", "n").join(ids, "rid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    lone = own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.union(lone)


def with_kept(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` and ``kept``: whether the row has its component's id.

    Rows without an id are kept unless a row with an id is in their component.
    """
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
