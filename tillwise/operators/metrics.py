"""Per-client order count and revenue, over all time and per event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.numbers import exact_sum


def _measures():
    return (F.count("*").alias("order_count"),
            exact_sum("total_amount").alias("total_revenue"))


def client_metrics(orders: DataFrame) -> DataFrame:
    return orders.groupBy("client_id").agg(*_measures())


def client_metrics_windowed(orders: DataFrame, width: str = "60 seconds",
                            lateness: str = "10 minutes") -> DataFrame:
    """Tumbling windows on order_date of enriched orders; ``lateness`` bounds the state of a stream.

    Orders without a date belong to no window; ``undated`` gives them with a reason.
    """
    if orders.isStreaming:
        orders = orders.withWatermark("order_date", lateness)
    return (orders.filter(F.col("order_date").isNotNull())
            .groupBy(F.window("order_date", width).alias("span"), "client_id").agg(*_measures())
            .select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
                    "client_id", "order_count", "total_revenue"))


def undated(orders: DataFrame) -> DataFrame:
    """Orders that no window can count, with the reason."""
    return orders.filter(F.col("order_date").isNull()).withColumn("reason", F.lit("no_date"))


def stamped(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("load_timestamp", F.current_timestamp())


def latest_metrics(versions: DataFrame) -> DataFrame:
    """The newest of the appended versions of each client's running totals."""
    newest = F.max_by(F.struct("order_count", "total_revenue", "load_timestamp"),
                      F.struct("load_timestamp", "batch_id"))
    return versions.groupBy("client_id").agg(newest.alias("m")).select("client_id", "m.*")
