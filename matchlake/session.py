"""Session construction and shared scratch locations.

Library code never creates its own session; callers pass one in.  The
builder here is for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes.  AQE re-plans joins and
# shuffle partition counts from runtime statistics and splits skewed join
# partitions; UTC keeps timestamp arithmetic free of host-zone effects.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "matchlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Where neither is set, a session that runs in one process (``local[...]``:
    tests, a laptop) gets a private folder; on a cluster that is an error,
    since executors would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="matchlake-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the checkpoint root."""
    return f"{checkpoint_root(spark)}/matchlake/{name}-{uuid.uuid4().hex}"


# Spark's setting: shuffle files go when the execution that made them ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes and actions begun in the block leave no shuffle files behind.

    For frames that are executed once: a second execution of the very same
    frame would have to make its shuffles again.
    """
    old = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if old is None else spark.conf.set(FREE_SHUFFLES, old)


def _write_at(path: str, df: DataFrame) -> DataFrame:
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, mode="append", compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df, name: str, *more: DataFrame):
    """Write ``df`` once under the checkpoint root and read it back.

    A stored table: every later use reads (and prunes) it instead of
    recomputing the lineage, and a lost executor only re-reads files.
    ``more`` frames of the same columns go into it one after another, each
    without the shuffle files of the others.
    """
    path = scratch_path(df.sparkSession, name)
    out = _write_at(path, df)
    for other in more:
        _write_at(path, other.select(*df.columns))
    return df.sparkSession.read.schema(df.schema).parquet(path) if more else out


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for as long as the block runs: the stored table is deleted after it."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _write_at(path, df)
    finally:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
