"""Registered queries: each binds an operator to the given tables, with its SQL twin."""

from . import layers, modelling, monitoring, profiles, scale, snapshots, streams  # noqa: F401
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
