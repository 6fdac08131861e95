"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str = "quotemill", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the library's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. A local session without that
    setting gets a temporary folder; any other session without it is an error, because
    a machine-local folder is lost together with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="quotemill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A few rows as literals of one JVM-side projection; no rows give an empty frame."""

    def struct(row: Sequence):
        cells = zip(row, schema.fields)
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in cells])

    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return spark.range(0).select(*nothing)
    return spark.range(1).select(F.inline(F.array(*[struct(r) for r in rows])))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and read it back.

    Cuts the lineage like a checkpoint but keeps column pruning and filter pushdown, for
    inputs that a plan reads more than once. The folder is the caller's to delete.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
