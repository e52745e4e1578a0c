"""Keyed totals that every batch of a stream is merged into.

The totals are a snapshot in buckets by a hash of the keys. A batch is aggregated first; its totals
are merged with those of the buckets they fall in, which are written anew, and one row of the table's
log (sources.batches) puts the new ones in the place of the old. So reading costs what the keys cost,
whatever the number of batches, a reader sees the totals after whole batches only, and a batch that is
repeated after a failure changes nothing. The row also records the last batch, so no other state is
kept. A bucket is one task when it is merged: choose so many that one fits, and keep to the number.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwise.functions.numbers import merged_units, unit_parts, units_value
from tillwise.schemas import CLIENT_TOTALS
from tillwise.sources import batches

BUCKETS = 64


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge(delta: DataFrame, path: str, writer: str, batch_id: int, keys: list[str],
          merging: list[Column], buckets: int = BUCKETS, note: str | None = None) -> None:
    """Merge a batch's totals into the snapshot. ``merging`` aggregates rows of old and new totals to
    columns of the same names; ``delta`` has one row per key at most few."""
    spark = delta.sparkSession
    now = batches.state(spark, path)
    if now.has(writer, batch_id):
        return
    delta = delta.withColumn("bucket", _bucket(keys, buckets)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r.bucket for r in delta.select("bucket").distinct().collect())  # at most the buckets
        old = [f for f in now.live if int(f.rsplit("=", 1)[1]) in set(touched)]
        before = _rows(spark, path, old, delta.drop("bucket").schema).withColumn("bucket", _bucket(keys, buckets))
        # Partitioned by bucket once: the aggregation and the files keep to it.
        (before.unionByName(delta).repartition(max(1, len(touched)), "bucket").groupBy("bucket", *keys).agg(*merging)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{writer}-{batch_id}"))
    finally:
        delta.unpersist()
    batches.commit(spark, path, writer, batch_id, [f"{writer}-{batch_id}/bucket={b}" for b in touched], old, note)


def _rows(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{f}" for f in folders))


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The totals as they are now."""
    return _rows(spark, path, batches.state(spark, path).live, schema)


# Client metrics ----------------------------------------------------------------------------------

def client_delta(orders: DataFrame) -> DataFrame:
    return orders.groupBy("client_id").agg(F.count("*").alias("order_count"), *unit_parts("total_amount"))


def merge_clients(orders: DataFrame, path: str, writer: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Add a batch of enriched orders to the totals of their clients."""
    merge(client_delta(orders), path, writer, batch_id, ["client_id"],
          [F.sum("order_count").alias("order_count"), *merged_units()], buckets)


def client_totals(spark: SparkSession, path: str) -> DataFrame:
    """client_id, order_count, total_revenue as of the last batch."""
    return read(spark, path, CLIENT_TOTALS).select("client_id", "order_count", units_value().alias("total_revenue"))
