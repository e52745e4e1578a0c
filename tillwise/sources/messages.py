"""Order messages: orders as keyed JSON text, and where such text is read from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.functions.times import moment

_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode_events(orders: DataFrame, sent_at: str | None = None,
                  limit: int | None = None, *kept: str) -> DataFrame:
    """One message per order: its id as ``key``, its JSON as ``value``.

    A NULL becomes a JSON null. ``product_id`` is sent if the input has it. ``limit`` stops after
    that many orders, in no particular order. Columns may be ``kept`` beside the message.
    """
    if limit is not None:
        orders = orders.limit(limit)
    product = [F.col("product_id")] if "product_id" in orders.columns else []
    body = F.struct(
        "order_id", "client_id", *product, "total_amount", "status",
        F.col("order_date").cast("string").alias("order_date"),
        F.date_format(moment(sent_at), _STAMP).alias("sent_at"))
    return orders.select(F.col("order_id").alias("key"), *kept,
                         F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_messages(messages: DataFrame, folder: str) -> None:
    """Append the messages to a folder, one per line."""
    messages.select("value").write.mode("append").text(folder)


def read_messages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(folder)


def stream_messages(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Files that arrive in a folder, as a stream of ``value``."""
    reader = spark.readStream.schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic as a stream of ``key`` and ``value``; needs the Kafka connector package."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).options(**options).load().select("key", "value"))


def write_topic(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send keyed messages to a Kafka topic; needs the Kafka connector package. Untested here."""
    (messages.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).options(**options).save())
