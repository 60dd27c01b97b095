"""The tabular load as a file stream.

Each micro-batch of newly landed match documents goes through
``plans.load.load_documents``.  ``foreachBatch`` may replay a batch after a
failure; a replay finds its documents loaded, or, where the first try was not
committed, loads them into a batch of its own, and known rejects are not
written again: the stream loads the star effectively exactly once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import MATCH
from ..sources.readers import documents_from
from .files import finish


def document_stream(spark: SparkSession, landing: str, schema: str = MATCH, multi_line: bool = False,
                    max_files_per_trigger: int | None = None, with_open: bool = False) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return documents_from(reader, landing, schema, multi_line, with_path=True, with_open=with_open)


def stream_documents(spark: SparkSession, landing: str, warehouse: str, checkpoint: str,
                     contract: Mapping[str, Mapping] | None = None, ignore: Sequence[str] = (),
                     multi_line: bool = False, max_files_per_trigger: int | None = None,
                     schema: str = MATCH, timeout_s: int | None = None, tables: Sequence[str] | None = None,
                     with_open: bool = False) -> None:
    """Load every document landed since the last run, then stop (availableNow).

    Runs to the end unless a ``timeout_s`` is given.
    """
    from ..plans.load import load_documents
    from ..plans.star import TABLES

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        load_documents(batch.sparkSession, batch, warehouse, contract, ignore, tables or TABLES)

    stream = document_stream(spark, landing, schema, multi_line, max_files_per_trigger, with_open)
    finish(stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start(), f"document stream from {landing}", timeout_s)
