"""Name → query and name → SQL, filled by the ``query`` decorator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Comparable across engines: doubles at six digits, dates as text."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            col = F.round(F.round(col, 9), 6) + F.lit(0.0)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, sf_dir))

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
