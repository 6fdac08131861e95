"""Compare a registered query with its SQL on the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    result = con.execute(sql)
    names, wanted = _rows([d[0] for d in result.description], result.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} != {names}"
    if got == wanted:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"rows {sum(got.values())} vs {sum(wanted.values())}; differing {sum(extra.values())}/"
        f"{sum(missing.values())}; got {list(extra)[:2]} wanted {list(missing)[:2]}"
    )
