"""Keyed upsert as a relational expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    flags: bool = False,
    newer: str | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Rows of ``target`` after upserting ``source``; keys match null-safely.

    Matched rows take ``update_columns`` (default: every non-key column) from the source.
    Source keys must be unique. With ``newer`` a matched row stays as it is unless the
    source row's value of that column is at least its own. ``flags`` adds ``_matched``
    (updated rows) and ``_inserted``. Without ``null_safe`` keys must not be null; the join
    then is on the plain columns and can use a stored bucketing by them.
    """
    keys = list(keys)
    updates = set(c for c in target.columns if c not in keys) if update_columns is None else set(update_columns)
    old = target.withColumn("_old", F.lit(True))
    new = source.select(*[F.col(c).alias(f"_new_{c}") for c in source.columns], F.lit(True).alias("_new"))
    pairs = [(F.col(k), F.col(f"_new_{k}")) for k in keys]
    same = reduce(lambda a, b: a & b, [k.eqNullSafe(n) if null_safe else k == n for k, n in pairs])
    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    taken = in_new
    if newer:
        taken = in_new & (~in_old | F.col(newer).isNull() | (F.col(f"_new_{newer}") >= F.col(newer)))
    columns = []
    for name in target.columns:
        if name not in source.columns:
            columns.append(F.col(name))
        elif name in updates:
            columns.append(F.when(taken, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.when(in_old, F.col(name)).otherwise(F.col(f"_new_{name}")).alias(name))
    if flags:
        columns += [(in_old & taken).alias("_matched"), (~in_old).alias("_inserted")]
    return old.join(new, same, "full_outer").select(*columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
