"""What the operators of this subpackage share: reading, defaults for nulls, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quotemill.session import stored

#: Rows of one Arrow batch. Texts can be very long, so batches are kept short.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, with Arrow batches short enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own removal of a query's shuffle files at its end.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``stored``, and the shuffle files of the write go once it is done.

    Work in many rounds would otherwise keep the shuffles of all of them on disk until the
    driver collects its garbage. The result is read from the table, so nothing asks for them.
    """
    conf = df.sparkSession.conf
    before = conf.get(_TIDY, "false")
    conf.set(_TIDY, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(_TIDY, before)


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty; other columns only where named."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *[F.col(f"`{c}`") for c in others],
    )


_KIND, _HELD = [""], {}


def turn(kind: str) -> None:
    """A worker that gets a task of another kind drops what it held for the last one."""
    if _KIND[0] != kind:
        _KIND[0] = kind
        _HELD.clear()


def held(key: Hashable, make: Callable):
    """An object that a worker makes once for all its tasks of one kind in a row."""
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[Sequence]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` for a generator of plain columns (lists or arrays) in schema order."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    kind = f"{fn.__module__}.{fn.__qualname__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn(kind)
        for columns in fn(batches):
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def with_columns_of_text(docs: DataFrame, fn: Callable[[list[str]], Sequence[Sequence]], added: str) -> DataFrame:
    """All columns of ``docs`` and those that ``fn`` makes of a batch of texts (null: empty).

    Columns of ``docs`` that share a name (in any case) with an added one are replaced; all
    others are kept, also with odd or repeated names.
    """
    new = StructType.fromDDL(added)
    taken = {f.name.lower() for f in new.fields}
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in taken]
    names = [docs.columns[i] for i in kept]
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*[f"c{i}" for i in kept])
    text = f"c{docs.columns.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Sequence]:
        for batch in batches:
            yield *batch.columns, *fn([t or "" for t in batch[text].to_pylist()])

    schema = StructType(plain.schema.fields + new.fields)
    return map_arrow(plain, run, schema).toDF(*names, *new.names)


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled rows with their texts: ``doc_id, text, label``.

    ``labels`` has ``doc_id, label``; rows without either are left out, and of repeated ids
    the largest label counts. The rows are the first by a hash of the id, so their number
    and with it the broadcast is bounded.
    """
    kept = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    return texts(docs).join(F.broadcast(kept), "doc_id")
