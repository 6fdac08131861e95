"""Merkle manifest of a dataset, its upper proofs acquired by butterfly exchange.

Every row is a leaf; leaves of a group (a source) stand in a fixed order, and every
``FANOUT`` consecutive nodes become their parent's digest until one node, the group's root,
remains. The groups' roots, in order of the group, are the leaves of one more tree.

A group is cut into aligned parts of ``FANOUT ** LEVELS`` leaves; a part hashes its own
levels alone. Above them parts work as in a butterfly network: in round r the ``FANOUT``
parts whose numbers differ in digit r only meet, swap the roots of the subtrees they hold
so far, and each of them hashes the common ancestor itself. After the last round every part
holds the root and all siblings on its way there, so nothing is sent back down. A subtree
at the end of a group has fewer parts than its neighbours; its last part stands in for the
missing ones.

Positions come from a range partitioning over (group, order) and prefix sums of the counts
per (partition, group), so a group that holds most rows is spread like any other. What moves
after the leaves are hashed are digests and ids, never texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.session import stored

from .tables import map_arrow

FANOUT = 16
#: Levels that a part hashes alone: parts of 4,096 leaves.
LEVELS = 3
#: Bytes of one Arrow batch; rows of parts are large.
BATCH_BYTES = 16 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each as its length in bytes and its text, ``-`` for null."""
    parts = []
    for value in values:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def digest(nodes: Sequence[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def levels_of(leaves: list[str], up: int | None, fanout: int) -> list[list[str]]:
    """The nodes level by level: ``up`` levels above the leaves, or until one node is left."""
    found = [leaves]
    while len(found) <= up if up is not None else len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return found


def placed(items: DataFrame, order: Sequence[str]) -> DataFrame:
    """``items`` with ``pos`` in the group ``key`` by ``order`` (nulls first) and the group's size ``n``."""
    ordered = stored(
        items.repartitionByRange("key", *[F.col(c).asc_nulls_first() for c in order])
        .sortWithinPartitions("key", *[F.col(c).asc_nulls_first() for c in order])
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("slice", F.shiftright("at", 33)),
        "leaves",
    )
    # One row per group and slice: at most groups + slices rows, at most one per slice in a window.
    counted = ordered.groupBy("key", "slice").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    group = Window.partitionBy("key")
    before = F.sum("held").over(group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    spans = counted.select(
        "key", "slice", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(group).alias("n")
    )
    return ordered.join(spans, ["key", "slice"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "slice", "shift")


def parts_of(items: DataFrame, payload: Sequence[str], size: int) -> DataFrame:
    """One row per part: ``key, part, n, leaves`` and the payload columns as arrays in leaf order."""
    row = F.struct("pos", "leaf", *payload)
    gathered = items.groupBy("key", F.expr(f"pos div {size}").alias("part"), "n").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    arrays = [F.col(f"rows.{c}").alias(c) for c in payload]
    return gathered.select("key", "part", "n", F.col("rows.leaf").alias("leaves"), *arrays)


def part_roots(parts: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``key, part, total, node``: the root of each part, ``total`` being the group's parts."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            nodes, totals = [], []
            for n, leaves in zip(batch["n"].to_pylist(), batch["leaves"].to_pylist()):
                totals.append(-(-n // fanout**levels))
                nodes.append(levels_of(leaves, None if totals[-1] == 1 else levels, fanout)[-1][0])
            yield batch["key"], batch["part"], totals, nodes

    return map_arrow(parts.select("key", "part", "n", "leaves"), run, "key string, part long, total long, node string")


def exchange(roots: DataFrame, fanout: int) -> DataFrame:
    """``key, part, node, runs``: the group's root and, level by level, the runs that lead there.

    In round r a part's unit is the subtree of ``fanout ** r`` parts it belongs to. It meets
    the parts of the neighbouring units that have its own offset in their unit. The last
    part of a unit cut short also goes where the offsets it lacks meet.
    """
    state = stored(roots.withColumn("runs", F.array().cast("array<array<string>>")), "butterfly")
    most = state.agg(F.max("total")).first()[0] or 1
    span = 1
    while span < most:
        unit, offset = F.expr(f"part div {span}"), F.col("part") % span
        waiting = state.where(F.col("total") <= span)
        here = state.where(F.col("total") > span).select(
            "*", F.expr(f"part div {span * fanout}").alias("group"), (unit % fanout).alias("seat"), offset.alias("offset")
        )
        stands_in = (F.col("part") == F.col("total") - 1) & (F.col("seat") > 0)
        lanes = F.sequence("offset", F.when(stands_in, F.lit(span - 1)).otherwise(F.col("offset")))
        sent = here.withColumn("lane", F.explode(lanes))
        own = F.when(F.col("lane") == F.col("offset"), F.struct("part", "total", "runs"))
        met = sent.groupBy("key", "group", "lane").agg(
            F.sort_array(F.collect_list(F.struct("seat", "node"))).alias("run"), F.collect_list(own).alias("members")
        )
        known = met.select("key", F.col("run.node").alias("run"), F.explode("members").alias("m")).select(
            "key", "m.part", "m.total",
            F.sha2(F.array_join("run", "").cast("binary"), 256).alias("node"),
            F.concat("m.runs", F.array("run")).alias("runs"),
        )
        state = stored(waiting.unionByName(known), "butterfly")
        span *= fanout
    return state.select("key", "part", "node", "runs")


def without(run: list[str], seat: int) -> tuple[str, str]:
    """What stands left and right of a seat in a run."""
    return "".join(run[:seat]), "".join(run[seat + 1 :])


def ways(leaves: list[str], part: int, total: int, runs: list[list[str]], fanout: int, levels: int) -> Iterator[list[tuple[str, str]]]:
    """For each leaf of a part: (left, right) siblings per level, from the leaf to the group's root."""
    own = levels_of(leaves, None if total == 1 else levels, fanout)[:-1]
    upper = [without(run, part // fanout**r % fanout) for r, run in enumerate(runs)]
    steps: list[dict[int, tuple[str, str]]] = [{} for _ in own]
    for i in range(len(leaves)):
        way = []
        for level, nodes in enumerate(own):
            at = i // fanout**level
            if at not in steps[level]:
                start = at - at % fanout
                steps[level] = {at: without(nodes[start : start + fanout], at - start)}
            way.append(steps[level][at])
        yield way + upper


def fold(leaf: str, way: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in way:
        leaf = sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def map_proofs(
    items: DataFrame,
    order: Sequence[str],
    payload: Sequence[str],
    visit: Callable[[dict[str, list], list[str], list[list[tuple[str, str]]], str, str], Iterator[tuple]],
    schema: str,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """Call ``visit`` for every part with its leaves and their ways to the root of all groups.

    ``items`` has a string ``key`` (the group; groups are ordered by it), ``leaf`` (hex) and
    the columns of ``order`` and ``payload``. ``visit(payload arrays, leaves, ways, subroot,
    root)`` yields the rows of ``schema``. Leaves equal in ``order`` stand in order of digest.
    """
    items.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    size = fanout**levels
    whole = placed(items, [*dict.fromkeys([*order, "leaf"])])
    parts = stored(parts_of(whole, payload, size), "parts")
    held = exchange(part_roots(parts, fanout, levels), fanout)
    heads = held.where("part = 0").select(F.lit("").alias("key"), F.col("key").alias("name"), F.col("node").alias("leaf"))
    head_parts = stored(parts_of(placed(heads, ["name"]), ["name"], size), "heads")
    head_held = exchange(part_roots(head_parts, fanout, levels), fanout)

    def top(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                found = ways(row["leaves"], row["part"], -(-row["n"] // size), row["runs"], fanout, levels)
                tops = [[{"left": a, "right": b} for a, b in way] for way in found]
                yield row["name"], row["leaves"], [row["node"]] * len(tops), tops

    tops = map_arrow(
        head_parts.join(head_held, ["key", "part"]), top,
        "key string, subroot string, root string, top array<struct<left: string, right: string>>",
    )
    # Joined to the thin rows of the parts, so that a large group is many small rows.
    upper = stored(held.select("key", "part", "runs").join(tops, "key"), "upper")

    def run(batches: Iterator[pa.RecordBatch]):
        width = None
        for batch in batches:
            for row in batch.to_pylist():
                total = -(-row["n"] // size)
                last = [(s["left"], s["right"]) for s in row["top"]]
                full = [way + last for way in ways(row["leaves"], row["part"], total, row["runs"], fanout, levels)]
                out = list(visit({c: row[c] for c in payload}, row["leaves"], full, row["subroot"], row["root"]))
                width = width or len(out[0])
                yield [[r[k] for r in out] for k in range(width)]

    return map_arrow(parts.join(upper, ["key", "part"]), run, schema)


def leaf_rows(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id", changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``key, id, leaf, other`` per row: the group's key (null first), the row's place and digest.

    ``other`` is the digest with the columns of ``changed`` in place of the stored ones, for
    rows that ``where`` picks; null for all others.
    """
    own = [F.col(c) for c in fields]
    other = F.lit(None).cast("string")
    if changed:
        other = F.when(where, leaf_digest([changed.get(c, F.col(c)) for c in fields]))
    name = F.col(group).cast("string")
    key = F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name))
    rows = docs.select(key.alias("key"), F.col(order).cast("long").alias("id"), leaf_digest(own).alias("leaf"), other.alias("other"))
    return stored(rows, "digests")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id") -> DataFrame:
    """Per row ``id, leaf, subroot, root, lefts, rights``: its digest and its whole proof.

    ``lefts[k]`` and ``rights[k]`` hold the concatenated digests beside the row's ancestor on
    level k, first in its group's tree, then in the tree of groups.
    """

    def visit(payload, leaves, paths, subroot, root):
        for i, leaf, way in zip(payload["id"], leaves, paths):
            yield i, leaf, subroot, root, [w[0] for w in way], [w[1] for w in way]

    schema = "id long, leaf string, subroot string, root string, lefts array<string>, rights array<string>"
    return map_proofs(leaf_rows(docs, fields, group, order), ["id"], ["id"], visit, schema)


def tamper_check(docs: DataFrame, divisor: int = 5) -> DataFrame:
    """Per row of ``docs`` its place in the manifest and whether its copy still fits it.

    Copies with ``crc32(doc_id) % divisor = 0`` have the A-Z of their text lower-cased.
    ``folded_root`` is what the copy and the original siblings lead to. Rows are leaves by
    ``doc_id`` (null first, never tampered with), equal ids by digest; repeated rows are
    leaves of their own. Nulls in any column have their own encoding, an empty table gives
    no rows, and columns other than the five hashed ones are ignored.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    picked = F.crc32(F.col("doc_id").cast("string")) % divisor == 0
    rows = leaf_rows(docs, changed={"text": lower}, where=picked)

    def visit(payload, leaves, paths, subroot, root):
        for i, leaf, other, way in zip(payload["id"], leaves, payload["other"], paths):
            proof = sha256("".join([f"{a}{b}" for a, b in way]).encode()).hexdigest()
            folded = fold(other or leaf, way)
            yield i, leaf, subroot, root, proof, folded, folded == root

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return map_proofs(rows, ["id"], ["id", "other"], visit, schema)
