"""Shared helpers of the training-data operators.

Row-wise operators run as ``mapInArrow`` over the caller's frame: the task
gets Arrow batches, cuts them to a few million bytes of text so that memory
does not follow the batch size, and appends its columns.  Nothing is shuffled
and a lost task is simply run again.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path

SLICE_BYTES = 2 << 20
#: Most bytes of a batch on its way to a Python worker; both sides hold it whole, Spark off its heap.
BATCH_BYTES = 2 * SLICE_BYTES
#: Most bits of a Bloom filter that guards a join (2 MB).
FILTER_BITS = 1 << 24


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``addPyFile``, once a session), and bound the batches they get:
    by default 10,000 rows of any length go at once."""
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(batch).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(batch, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if getattr(sc, "_matchlake_shipped", False):
        return
    package = os.path.join(root, "matchlake")
    to = os.path.join(tempfile.mkdtemp(prefix="matchlake-py-"), "matchlake.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(to)
    sc._matchlake_shipped = True


def store(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text or list items (a longer row stays whole)."""
    if not batch.num_rows:
        return
    data = batch.column(column)
    size = pc.list_value_length(data) if pa.types.is_list(data.type) else pc.binary_length(data)
    size = pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64) * (4 if pa.types.is_list(data.type) else 1)
    part = np.cumsum(size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def append_columns(df: DataFrame, needs: list[str], fields: list[tuple[str, str]],
                   start: Callable[[], Callable], sliced_by: str, limit: int = SLICE_BYTES,
                   keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with new columns computed batch-wise in Python.

    ``start()`` runs once in each task and returns ``work(*arrays)`` which takes
    the Arrow arrays of ``needs`` and returns one Arrow array for each of
    ``fields`` (name, DDL type).  A column of ``df`` that has the name of a new
    one (in any case) is replaced.  Columns go by position inside, so clashing names are safe.
    """
    names = df.columns
    at = [names.index(n) for n in needs]
    new = [n for n, _ in fields]
    kept = [i for i, n in enumerate(names) if n.lower() not in {x.lower() for x in new} and (keep is None or n in keep)]
    inner = df.toDF(*[f"c{i}" for i in range(len(names))])
    inside = list(dict.fromkeys([*kept, *at]))
    inner = inner.select(*[f"c{i}" for i in inside])
    pos = {c: k for k, c in enumerate(inside)}
    cut = pos[names.index(sliced_by)]
    schema = T.StructType([T.StructField(f"k{j}", df.schema[i].dataType, True) for j, i in enumerate(kept)]
                          + [T.StructField(f"n{j}", T._parse_datatype_string(t), True) for j, (_, t) in enumerate(fields)])
    arrow = to_arrow_schema(schema)
    takes, gives = [pos[i] for i in at], [pos[i] for i in kept]

    def run(batches):
        work = start()
        for batch in batches:
            for part in slices(batch, cut, limit):
                out = work(*[part.column(i) for i in takes])
                arrays = [part.column(i) for i in gives] + list(out)
                arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    return inner.mapInArrow(run, schema).toDF(*[names[i] for i in kept], *new)


def texts_of(array: pa.Array) -> list[str]:
    """Python strings; null is empty."""
    return [t if t is not None else "" for t in array.to_pylist()]


@contextmanager
def bloom_filters(spark: SparkSession):
    """Let inner joins that run inside filter their larger side by a Bloom filter of the smaller one's keys."""
    name = "spark.sql.optimizer.runtime.bloomFilter."
    items = str(FILTER_BITS // 8)
    conf = {"enabled": "true", "creationSideThreshold": "100g", "applicationSideScanSizeThreshold": "0", "expectedNumItems": items,
            "maxNumItems": items, "numBits": str(FILTER_BITS), "maxNumBits": str(FILTER_BITS)}
    before = {k: spark.conf.get(name + k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(name + k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(name + k, v)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the column's text modulo ``n``; null stays null."""
    return F.crc32(col.cast("string").cast("binary")) % n


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (SplitMix64 constants), element-wise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(texts: list[str], separator: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each preceded by ``separator``; and the n + 1 offsets of those separators."""
    joined = separator + separator.join(texts) if texts else ""
    size = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return (np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32),
            np.concatenate([[0], np.cumsum(size)]).astype(np.int64))
