"""The manifest against a plain tree built row by row."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quotemill.llm import merkle
from tests.llm.tables import awkward, empty, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout=16):
    """(root, per node its list of runs with the own seat)."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for way, a in zip(ways, at):
            way.append((runs[a // fanout], a % fanout))
        at = [a // fanout for a in at]
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], ways


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        def key(r):
            return (r["doc_id"] is not None, r["doc_id"] or 0, leaf([r[c] for c in merkle.FIELDS]))
        mine = sorted(groups[s], key=key)
        trees[s] = (mine, *climb([leaf([r[c] for c in merkle.FIELDS]) for r in mine]))
    root, tops = climb([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        mine, subroot, ways = trees[s]
        for r, way in zip(mine, ways):
            own = leaf([r[c] for c in merkle.FIELDS])
            full = way + top
            proof = sha("".join("".join(run[:i] + run[i + 1 :]) for run, i in full))
            node = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                node = leaf([r[c].translate(LOWER) if c == "text" else r[c] for c in merkle.FIELDS])
            for run, i in full:
                node = sha("".join(run[:i] + [node] + run[i + 1 :]))
            out.append((r["doc_id"], own, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = found(merkle.tamper_check(docs))
    assert got == brute(docs.collect())
    assert not all(r[-1] for r in got)


def test_empty_table(spark):
    assert merkle.tamper_check(empty(spark)).count() == 0


@pytest.mark.parametrize("rows", [1, 2, 16, 17, 256, 257, 700])
def test_shapes(spark, rows):
    """Sources with any number of leaves, most rows in one of them."""
    sources = [None, "", "a", "Ä", "z"]
    docs = spark.createDataFrame(
        [(i * 3, sources[0 if i % 3 else i % 5], "en", i, f"Text {i} {prose(3, i)}") for i in range(rows)],
        "doc_id long, source string, lang string, n_chars long, text string",
    )
    assert found(merkle.tamper_check(docs)) == brute(docs.collect())


@pytest.mark.parametrize("rows", [5, 8, 9, 31, 64, 65, 100])
def test_many_rounds(spark, rows):
    """Fanout two and parts of two leaves: many rounds, units cut short on every level."""
    rows_in = [("=g" if i % 4 else "=h", i, sha(str(i))) for i in range(rows)]
    items = spark.createDataFrame(rows_in, "key string, id long, leaf string")

    def visit(payload, leaves, paths, subroot, root):
        for i, own, way in zip(payload["id"], leaves, paths):
            yield i, subroot, root, merkle.fold(own, way), len(way)

    schema = "id long, subroot string, root string, folded string, steps long"
    got = merkle.map_proofs(items, ["id"], ["id"], visit, schema, fanout=2, levels=1).collect()
    trees = {k: climb([r[2] for r in rows_in if r[0] == k], 2) for k in ("=g", "=h")}
    root = climb([trees["=g"][0], trees["=h"][0]], 2)[0]
    assert len(got) == rows
    for r in got:
        key = "=g" if r.id % 4 else "=h"
        assert (r.subroot, r.root, r.folded) == (trees[key][0], root, root)
        assert r.steps == len(trees[key][1][0]) + 1


def test_many_groups_are_a_tree_of_their_own(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source"), F.lit("en").alias("lang"),
        F.lit(None).cast("long").alias("n_chars"), F.concat(F.lit("Word "), F.col("id")).alias("text"),
    )
    assert found(merkle.tamper_check(docs)) == brute(docs.collect())


def test_manifest_proofs_lead_to_the_root(spark):
    rows = merkle.manifest(awkward(spark)).collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        assert merkle.fold(r.leaf, list(zip(r.lefts, r.rights))) == r.root
