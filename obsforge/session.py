"""Session settings this package relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Runtime settings only; sizing (executors, shuffle partitions) belongs to the cluster.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value instead of failing the page
    "spark.sql.variant.allowDuplicateKeys": "true",
    # wide projections run faster as split methods the JVM can compile than as one it cannot
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators need for exact results."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's own checkpoint folder.

    Only a local session, where driver and executors share one disk, may fall
    back to a temporary folder; a cluster must name a folder all nodes see.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"obsforge-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


_open: ContextVar[list[str] | None] = ContextVar("staged paths", default=None)


def staged(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage with data that outlives any executor, keeps statistics,
    and lets several later aggregations read just the columns they need. A
    ``lasting`` table stays when a ``released`` block around it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    paths = _open.get()
    if paths is not None and not lasting:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends; nothing may read it after that."""
    before, own = _open.get(), []
    _open.set(own)
    try:
        yield
    finally:
        _open.set(before)
        jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in own:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(settings).delete(folder, True)
