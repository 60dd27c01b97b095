"""File-stream forms of the incremental loads.

A run processes only files not seen by an earlier run (the stream
checkpoint remembers them).  ``keep_first`` stores the first row per id over
all time and holds no state but what it has stored; ``dedupe_within_watermark``
keeps the first row per id among rows that arrive within the watermark delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nested import q
from ..sources.commits import missing

#: Partition of a keep-first sink: the micro-batch that wrote it.
EPOCH = "_epoch"


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def finish(query, what: str, timeout_s: int | None = None) -> None:
    """Wait to the end; with ``timeout_s``, stop and raise after that."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"{what} did not finish in {timeout_s}s")
    if query.exception():
        raise query.exception()


def run_available(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                  timeout_s: int | None = None) -> None:
    """Process everything available now, then stop (exactly-once file sink)."""
    finish(stream.writeStream.format(fmt).option("checkpointLocation", checkpoint)
           .outputMode("append").trigger(availableNow=True).start(sink_path), f"stream to {sink_path}", timeout_s)


def dedupe_within_watermark(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Keep the first row per ``keys`` seen within ``delay`` of event time.

    State is bounded by the watermark; a duplicate arriving later than
    ``delay`` after the first copy passes again.  ``event_time`` is cast
    to ``timestamp`` (watermarks need it).
    """
    return (stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
                  .withWatermark(event_time, delay)
                  .dropDuplicatesWithinWatermark(keys))


def read_kept(spark: SparkSession, sink_path: str, schema: str) -> DataFrame:
    """The rows that ``keep_first`` has stored, with their micro-batch in ``_epoch``; none before the first run."""
    try:
        return spark.read.schema(f"{schema}, {EPOCH} bigint").parquet(sink_path)
    except AnalysisException as e:
        if missing(e):
            return spark.createDataFrame([], f"{schema}, {EPOCH} bigint")
        raise


def keep_first(stream: DataFrame, sink_path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str] = (),
               timeout_s: int | None = None) -> None:
    """Store the first row of each ``keys`` of all that is available now, then stop.

    A micro-batch is reduced to one row per key (the least by ``order``, nulls first, then by content) with a
    partial aggregate, less the keys that are stored.  So memory follows the micro-batch and not the ids of all time,
    and no delay has to be set.  A micro-batch overwrites a partition of its own and looks at earlier ones only, so
    a replay stores the same.  Null keys are keys.
    """
    schema = stream.schema
    columns = [f"{q(f.name)} {f.dataType.simpleString()}" for f in schema.fields]

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in schema.names if c not in keys and c not in order]
        least = F.min(F.struct(*[F.col(q(c)) for c in [*order, *rest]])).alias("_first")
        first = batch.groupBy(*[q(k) for k in keys]).agg(least).select(*[q(k) for k in keys], "_first.*").select(*[q(c) for c in schema.names])
        kept = read_kept(spark, sink_path, ", ".join(columns)).filter(F.col(EPOCH) < epoch).select(*[F.col(q(k)).alias(f"_k{i}") for i, k in enumerate(keys)])
        same = None
        for i, k in enumerate(keys):
            one = first[q(k)].eqNullSafe(kept[f"_k{i}"])
            same = one if same is None else same & one
        (first.join(kept, same, "left_anti").withColumn(EPOCH, F.lit(epoch)).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy(EPOCH).parquet(sink_path))

    finish(stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(),
           f"keep-first stream to {sink_path}", timeout_s)
