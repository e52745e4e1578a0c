"""The order stream: clean, enrich, append; running and windowed client metrics of what was appended.

Metrics read the table of enriched orders as a stream, so their stateful plans hold no join.

Each batch goes to a folder named after the query's checkpoint and the batch number. A batch that
is repeated after a failure replaces its folder, so the sink holds it once; another query with a
checkpoint of its own appends next to it.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tillwise.operators.clean import accepted, assess
from tillwise.operators.clean import rejected as rejects_of
from tillwise.operators.enrich import enrich
from tillwise.operators.metrics import client_metrics, client_metrics_windowed, stamped
from tillwise.schemas import with_columns


def _append(batch: DataFrame, path: str, checkpoint: str, batch_id: int) -> None:
    writer = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    batch.write.mode("overwrite").parquet(f"{path}/writer={writer}/batch_id={batch_id}")


def read_sink(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Everything appended so far, with ``writer`` and ``batch_id``."""
    full = with_columns(schema, writer="string", batch_id="long")
    return spark.read.schema(full).parquet(path)


def stream_sink(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
                ) -> DataFrame:
    """What is appended to a table, as a stream."""
    reader = spark.readStream.schema(with_columns(schema, writer="string", batch_id="long"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).drop("writer", "batch_id")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were not counted, in the batches Spark remembers."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress
               for state in progress.stateOperators)


def _started(writer: DataStreamWriter, checkpoint: str, available_now: bool,
             every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def start_cleaning(messages: DataFrame, clients: DataFrame, products: DataFrame, *,
                   orders_path: str, rejects_path: str, checkpoint: str, form: str = "union",
                   available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Append enriched orders to one table and unusable messages to another.

    ``clients`` and ``products`` have one row per key (operators.dimensions).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        assessed = assess(batch).persist(StorageLevel.MEMORY_AND_DISK)  # both outputs, one parse
        try:
            _append(enrich(accepted(assessed), clients, products, form), orders_path, checkpoint,
                    batch_id)
            _append(rejects_of(assessed), rejects_path, checkpoint, batch_id)
        finally:
            assessed.unpersist()

    return _started(messages.writeStream.foreachBatch(write), checkpoint, available_now, every)


def start_appending(rows: DataFrame, *, path: str, checkpoint: str, mode: str = "append",
                    available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Append what a stream puts out to a table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _append(batch, path, checkpoint, batch_id)

    return _started(rows.writeStream.outputMode(mode).foreachBatch(write), checkpoint,
                    available_now, every)


def start_metrics(orders: DataFrame, *, metrics_path: str, checkpoint: str,
                  available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Append each client's running totals whenever they change. ``orders`` is a stream of enriched
    orders (``stream_sink``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _append(stamped(batch), metrics_path, checkpoint, batch_id)

    return _started(client_metrics(orders).writeStream.outputMode("update").foreachBatch(write),
                    checkpoint, available_now, every)


def start_windowed_metrics(orders: DataFrame, *, metrics_path: str, checkpoint: str,
                           width: str = "60 seconds", lateness: str = "10 minutes",
                           available_now: bool = False,
                           every: str | None = None) -> StreamingQuery:
    """Append each client's totals per window once the watermark has passed its end. ``orders`` is
    a stream of enriched orders in about their order of date; ``late_rows`` counts those that came
    later than ``lateness`` allows."""
    return start_appending(client_metrics_windowed(orders, width, lateness), path=metrics_path,
                           checkpoint=checkpoint, available_now=available_now, every=every)
