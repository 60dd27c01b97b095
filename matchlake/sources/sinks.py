"""Writers: append, replace, re-run-safe overwrite, landing, run logs.

Targets are paths (Parquet unless ``fmt`` says otherwise) or, when the
name has no ``/``, catalog tables.  All writes go through Spark's commit
protocol, so a lost executor only re-runs its tasks.

A replaced table is never half there: each content is written to a folder of
its own, and then made the current one by a commit in the table's log (a path)
or by replacing the view of that name (a catalog).  A job that fails leaves the
old content, and readers that have begun go on with the content they know.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import md5_key
from ..functions.time import ISO_SECONDS, parse_ts
from ..schemas import CONTENT_COMMIT
from .commits import CommitLog, file_system


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _with_schema(df: DataFrame, schema: str | None) -> DataFrame:
    """``df`` in the columns, order and types of a DDL ``schema``; a missing or uncastable column is an error."""
    return df if schema is None else df.to(df.sparkSession.createDataFrame([], schema).schema)


def append(df: DataFrame, target: str, fmt: str = "parquet", partition_by: Sequence[str] = (), schema: str | None = None) -> None:
    """Append rows, in an explicit ``schema`` where one is given."""
    w = _with_schema(df, schema).write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target) if _is_path(target) else w.saveAsTable(target)


def _contents(spark: SparkSession, target: str) -> CommitLog:
    return CommitLog(spark, f"{target.rstrip('/')}/contents", CONTENT_COMMIT)


def replace(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Replace the whole table (create-or-replace semantics); a path is read with ``read_replaced``.

    In a catalog, ``target`` becomes a view of the new content; a table of that name made elsewhere is overwritten
    in place.  Of writers that replace at once, the last to finish wins.
    """
    spark = df.sparkSession
    if _is_path(target):
        folder = f"{target.rstrip('/')}/content-{uuid.uuid4().hex}"
        w = df.write.format(fmt)
        (w.option("compression", "zstd") if fmt == "parquet" else w).save(folder)
        log = _contents(spark, target)
        while not log.put(log.latest() + 1, folder=folder.rsplit("/", 1)[1], format=fmt, columns=df.schema.json()):
            pass
        return
    if spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType not in ("VIEW", "TEMPORARY"):
        df.write.mode("overwrite").format(fmt).saveAsTable(target)
        return
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = f"{root}/{target.replace('.', '/')}/content-{uuid.uuid4().hex}"
    df.write.format(fmt).save(folder)
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {fmt}.`{folder}`")


def read_replaced(spark: SparkSession, target: str) -> DataFrame:
    """The current content of a replaced table."""
    if not _is_path(target):
        return spark.table(target)
    now = _contents(spark, target).frame().orderBy(F.desc("version")).first()
    if now is None:
        raise FileNotFoundError(f"{target} has no content yet")
    return spark.read.schema(T._parse_datatype_json_string(now["columns"])).format(now["format"]).load(f"{target.rstrip('/')}/{now['folder']}")


def drop_old_contents(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` contents of a replaced path, for when no reader uses them any more; returns how
    many."""
    old = _contents(spark, target).frame().orderBy(F.desc("version")).offset(max(1, keep)).select("folder")
    dropped = 0
    for r in old.toLocalIterator():
        fs, path = file_system(spark, f"{target.rstrip('/')}/{r['folder']}")
        dropped += bool(fs.delete(path, True))
    return dropped


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Publish ``df`` as a session view (created or replaced), and return it by that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Re-run-safe load: rewrite only the partitions present in ``df``.

    Dynamic partition overwrite: loading the same batch twice leaves the
    same rows, other partitions are untouched.  Partition on a bounded
    column (a hash bucket of the document id, or the load date), not on
    the id itself, to avoid one small file per document.
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    w.format(fmt).save(path)


def land_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Store documents as JSON Lines (one document per line).

    With ``partition_by``, a folder for each of its values (many, where it is
    the document's id): the values are dealt to all cores, whatever the rows'
    size, and each task puts its files in place itself instead of leaving all
    to the driver at the end of the job.  A landing that dies may leave some of
    its documents behind.
    """
    w = df
    if partition_by:
        n = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        w = df.repartition(n, *partition_by)
    w = w.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    w.json(path)


def snapshot(ids: DataFrame, run_time: str, id_col: str = "matchid") -> DataFrame:
    """Timestamped snapshot rows ``(datetime, matchid)`` of the given ids."""
    return ids.select(parse_ts(F.lit(run_time)).alias("datetime"), F.col(id_col).alias("matchid"))


def error_log(responses: DataFrame, run_time, ok_status: int = 200) -> DataFrame:
    """Rows for failed calls: ``id, datetime, name, tag, endpoint, status``.

    ``id`` is the MD5 of run time + name + tag; ``run_time`` is local
    text in ``yyyy-MM-dd'T'HH:mm:ss``, one string for the whole run or a
    column holding each call's own time.
    """
    rt = F.lit(run_time) if isinstance(run_time, str) else run_time
    failed = responses.filter(F.col("status") != ok_status)
    return failed.select(
        md5_key(rt, "name", "tag").alias("id"),
        parse_ts(rt, ISO_SECONDS).alias("datetime"),
        "name", "tag", "endpoint", F.col("status").cast("int").alias("status"))
