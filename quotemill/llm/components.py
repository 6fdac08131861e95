"""Connected components of a graph given as an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.concat_ws(",", "u", "v")))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge: the smallest node of its component.

    ``edges`` has long columns ``u, v``. Every step combines map-side or joins on nodes, so
    a node with very many edges is split like any skewed join; no component is ever
    gathered. The number of rounds grows with the logarithm of the longest chain. Each
    round is written to the shared scratch folder. Loops and repeated edges do no harm; no
    edges give no rows.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(now.distinct(), "edges")
    sign = _sign(now)
    while sign[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, sign = sign, _sign(now)
        if before == sign:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
