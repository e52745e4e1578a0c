"""The order stream over tables of finished batches (sources.batches).

Every stage follows the log of the table before it and takes one finished batch at a time, however
many files it has; what it writes is one finished batch of the next table, under the same number after
a failure. So no stage sees half a batch, and none needs files of a certain size or order.

Dimensions are published as versions. A batch looks up the newest once and records it before it
joins, so that a repeated batch joins the same version, and the next batch sees what has changed.

Windowed metrics keep their own high-water mark of event time. Orders behind it by more than the
lateness are set aside with the reason ``late``, those without a date with ``no_date``, all others are
counted, so that nothing is lost: counted, late and undated orders are all orders.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillwise import schemas
from tillwise.functions.numbers import merged_units, unit_parts, units_value
from tillwise.operators.clean import accepted, assess
from tillwise.operators.clean import rejected as rejects_of
from tillwise.operators.enrich import FORMS, enrich
from tillwise.schemas import MESSAGES, WINDOW_TOTALS
from tillwise.sources import batches
from tillwise.streaming import merged

# Registers of a distinct-count sketch (a power of two) and the relative error that three standard
# deviations of its estimate allow.
LOG_REGISTERS = 14
ERROR = 3 * 1.04 / (1 << LOG_REGISTERS) ** 0.5


def start(spark: SparkSession, source: str, schema: StructType, work: Callable[[DataFrame, int], None], *,
          checkpoint: str, one_by_one: bool = True, available_now: bool = False, every: str | None = None
          ) -> StreamingQuery:
    """Call ``work`` with the rows of each finished batch of a table and its number in this stream."""
    def run(entries: DataFrame, batch_id: int) -> None:
        named = entries.select("writer", "batch_id", "adds").collect()  # one row per batch
        if named:  # a trigger may have met no more than files moved together
            work(batches.of_entries(entries.sparkSession, source, named, schema).drop("writer", "batch_id"), batch_id)

    writer = batches.follow(spark, source, one_by_one).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


# Dimensions --------------------------------------------------------------------------------------

def publish(dimension: DataFrame, path: str) -> int:
    """Make this the newest version of a dimension; returns its number."""
    spark = dimension.sparkSession
    number = batches.state(spark, path).done.get("publish", -1) + 1
    batches.replace(dimension, path, "publish", number)
    return number


def pinned(spark: SparkSession, path: str, writer: str, batch_id: int, dimensions: dict[str, str]) -> dict[str, list[str]]:
    """The folders of each dimension that a batch joins: the newest when it first asks, the same when
    it is repeated. Old versions must outlive the batch that may be repeated (``batches.sweep``)."""
    now = batches.state(spark, path)
    if now.done.get(writer) == batch_id:
        return json.loads(now.notes[writer])
    found = {name: batches.state(spark, place).live for name, place in dimensions.items()}
    batches.commit(spark, path, writer, batch_id, [], note=json.dumps(found))
    return found


def start_cleaning(spark: SparkSession, source: str, clients: str, products: str, *, orders_path: str, rejects_path: str,
                   checkpoint: str, form: str = "joined", writer: str = "cleaning", **more) -> StreamingQuery:
    """Messages to enriched orders and rejects. ``clients`` and ``products`` are the paths of published
    dimensions with one row per key."""
    dims = {"clients": clients, "products": products}

    def work(messages: DataFrame, batch_id: int) -> None:
        session = messages.sparkSession
        if all(batches.state(session, p).has(writer, batch_id) for p in (orders_path, rejects_path)):
            return
        versions = pinned(session, f"{orders_path}/_versions", writer, batch_id, dims)
        sides = [session.read.parquet(*(f"{dims[name]}/{f}" for f in versions[name])) for name in dims]
        # A batch is few files, each one task of the scan; parsing costs more than dealing them out.
        dealt = messages.repartition(int(session.conf.get("spark.sql.shuffle.partitions")))
        assessed = assess(dealt).persist(StorageLevel.MEMORY_AND_DISK)  # both outputs, one parse
        try:
            batches.append(rejects_of(assessed), rejects_path, writer, batch_id)
            batches.append(enrich(accepted(assessed), *sides, form), orders_path, writer, batch_id)
        finally:
            assessed.unpersist()
        batches.keep_small(session, orders_path, FORMS[form][1], batch_id)
        batches.keep_small(session, rejects_path, schemas.REJECTS, batch_id)

    return start(spark, source, MESSAGES, work, checkpoint=checkpoint, **more)


# Metrics -----------------------------------------------------------------------------------------

def start_totals(spark: SparkSession, source: str, *, path: str, checkpoint: str, schema: StructType = schemas.ENRICHED_ORDERS,
                 writer: str = "totals", buckets: int = merged.BUCKETS, **more) -> StreamingQuery:
    """Running totals per client of the enriched orders (``merged.client_totals`` reads them)."""
    def work(orders: DataFrame, batch_id: int) -> None:
        merged.merge_clients(orders, path, writer, batch_id, buckets)
        if (batch_id + 1) % batches.TOGETHER == 0:
            batches.fold(orders.sparkSession, path)
            batches.sweep(orders.sparkSession, path)

    return start(spark, source, schema, work, checkpoint=checkpoint, **more)


_WINDOW = ["window_start", "window_end", "client_id"]


def _late_schema(schema: StructType) -> StructType:
    return schemas.with_columns(schema, reason="string")


def merge_windows(orders: DataFrame, path: str, writer: str, batch_id: int, width: str = "60 seconds",
                  lateness: timedelta = timedelta(minutes=10)) -> None:
    """Count a batch of enriched orders in its windows.

    The mark is the latest date of the batches before. A window that ended ``lateness`` before it is
    closed: an order that falls in it is late. Windows that this batch closes move to the closed ones.
    The open windows are written last and with the new mark, so a repeated batch starts from the same
    state and the outputs it had finished stay as they are.
    """
    spark = orders.sparkSession
    now = batches.state(spark, f"{path}/open")
    if now.has(writer, batch_id):
        return
    before = now.notes.get(writer)

    def limit(mark: str | None) -> Column:
        behind = int(lateness.total_seconds() * 1_000_000)
        return F.lit(None).cast("timestamp") if mark is None else F.timestamp_micros(F.lit(int(mark) - behind))

    span = F.window("order_date", width)
    # A projection of window() drops rows without a date, so the window is looked at only where there is one.
    undated = orders.where("order_date IS NULL").withColumn("reason", F.lit("no_date"))
    dated = (orders.where("order_date IS NOT NULL").withColumn("span", span)
             .withColumn("reason", F.when(F.col("span.end") <= limit(before), "late")).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        batches.append(dated.where("reason IS NOT NULL").drop("span").unionByName(undated), f"{path}/left_out", writer, batch_id)
        latest = dated.agg(F.unix_micros(F.max("order_date")).alias("mark")).first().mark
        mark = max((int(m) for m in (before, latest) if m is not None), default=None)
        delta = (dated.where("reason IS NULL").select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
                                                      "client_id", "total_amount")
                 .groupBy(*_WINDOW).agg(F.count("*").alias("order_count"), *unit_parts("total_amount")))
        held = batches.read_whole(spark, f"{path}/open", WINDOW_TOTALS)
        windows = (held.unionByName(delta).groupBy(*_WINDOW).agg(F.sum("order_count").alias("order_count"), *merged_units())
                   .persist(StorageLevel.MEMORY_AND_DISK))
        over = F.coalesce(F.col("window_end") <= limit(None if mark is None else str(mark)), F.lit(False))
        try:
            batches.append(windows.where(over), f"{path}/closed", writer, batch_id)
            batches.replace(windows.where(~over), f"{path}/open", writer, batch_id, None if mark is None else str(mark))
        finally:
            windows.unpersist()
    finally:
        dated.unpersist()


def start_windows(spark: SparkSession, source: str, *, path: str, checkpoint: str, width: str = "60 seconds",
                  lateness: timedelta = timedelta(minutes=10), schema: StructType = schemas.ENRICHED_ORDERS,
                  writer: str = "windows", **more) -> StreamingQuery:
    """Windowed metrics of the enriched orders, with the late and undated ones beside them."""
    def work(orders: DataFrame, batch_id: int) -> None:
        session = orders.sparkSession
        merge_windows(orders, path, writer, batch_id, width, lateness)
        if (batch_id + 1) % batches.TOGETHER == 0:
            batches.fold(session, f"{path}/open")
            batches.sweep(session, f"{path}/open")
        batches.keep_small(session, f"{path}/closed", WINDOW_TOTALS, batch_id)
        batches.keep_small(session, f"{path}/left_out", _late_schema(schema), batch_id)

    return start(spark, source, schema, work, checkpoint=checkpoint, **more)


def windows_of(spark: SparkSession, path: str) -> DataFrame:
    """Metrics of all windows; ``closed`` tells those that no later order changes."""
    closed = batches.read(spark, f"{path}/closed", WINDOW_TOTALS).drop("writer", "batch_id").withColumn("closed", F.lit(True))
    still = batches.read_whole(spark, f"{path}/open", WINDOW_TOTALS).withColumn("closed", F.lit(False))
    return closed.unionByName(still).select(*_WINDOW, "order_count", units_value().alias("total_revenue"), "closed")


def left_out(spark: SparkSession, path: str, schema: StructType = schemas.ENRICHED_ORDERS) -> DataFrame:
    """Orders that no window counts, with the reason."""
    return batches.read(spark, f"{path}/left_out", _late_schema(schema)).drop("writer", "batch_id")


# Distinct counts ---------------------------------------------------------------------------------

def _sketches(group: StructType) -> StructType:
    return StructType([*group.fields]).add("sketch", "binary")


def start_distinct(spark: SparkSession, source: str, schema: StructType, *, group: dict[str, Column], value: str, path: str,
                   checkpoint: str, writer: str = "distinct", **more) -> StreamingQuery:
    """Keep a sketch of the distinct values per group and batch. Sketches of any batches can be put
    together, which counts cannot; NULL is no value."""
    def work(rows: DataFrame, batch_id: int) -> None:
        sketch = F.hll_sketch_agg(value, LOG_REGISTERS).alias("sketch")
        per_group = rows.groupBy(*(c.alias(name) for name, c in group.items())).agg(sketch)
        batches.append(per_group, path, writer, batch_id)
        batches.keep_small(rows.sparkSession, path, StructType([f for f in per_group.schema]), batch_id)

    return start(spark, source, schema, work, checkpoint=checkpoint, **more)


def distinct_counts(spark: SparkSession, path: str, groups: str, name: str = "distinct_values") -> DataFrame:
    """Estimated number of distinct values per group over all batches, within ``ERROR`` of it.
    ``groups`` are the group columns with their types."""
    kept = batches.read(spark, path, _sketches(StructType.fromDDL(groups)))
    keys = StructType.fromDDL(groups).fieldNames()
    return kept.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
