"""Shop tables derived from a star schema (customer, orders, lineitem, part, events, ...).

The star schema has no NULLs, no e-mails, ages or registration dates and no faulty messages. These
are derived from the keys by fixed formulas over every row; FIXTURES.md lists them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwise import schemas, scratch
from tillwise.sources.messages import encode_events, write_messages

AS_OF = "2001-08-02 00:00:00"
FIRST_YEAR = 1995  # of the orders

# Columns of the star schema that the shop tables use; given, so that no file is opened to infer.
STAR = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(STAR[table]).parquet(f"{folder}/{table}.parquet")


def clients(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    address = F.concat(F.lit("user"), k, F.when(k % 200 == 7, F.lit("at")).otherwise("@"),
                       F.lit("shop.example"))
    age = (F.when(k % 50 == 3, None).when(k % 300 == 11, 5).when(k % 300 == 17, 110)
           .otherwise(18 + k % 58))
    customers = read(spark, folder, "customer").join(
        read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return schemas.conform(customers.select(
        k.alias("client_id"),
        F.concat(F.lit("L"), k).alias("last_name"),
        F.col("c_name").alias("first_name"),
        address.alias("email"),
        age.alias("age"),
        F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("Non-binary").alias("gender"),
        F.when(k % 40 != 21, F.col("n_name")).alias("country"),
        F.date_add(F.lit("1995-01-01").cast("date"), (k % 80 * 30).cast("int"))
        .alias("registration_date"),
        F.col("c_mktsegment").alias("segment")), schemas.CLIENTS)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return schemas.conform(read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("unit_price"),
        F.col("p_size").alias("stock")), schemas.PRODUCTS)


def _status(k: Column) -> Column:
    code = F.col("o_orderstatus")
    return (F.when(k % 50 == 49, None).when(code == "F", "Cancelled")
            .when((code == "O") & (k % 10 == 3), "Refunded").when(code == "O", "Delivered")
            .otherwise("Pending"))


def _order_columns(region: Column | None = None) -> list[Column]:
    k = F.col("o_orderkey")
    made = {"order_id": k, "client_id": F.col("o_custkey"), "order_date": F.col("o_orderdate"),
            "status": _status(k), "payment_method": F.col("o_orderpriority"), "region": F.lit(None) if region is None else region,
            "total_amount": F.when(k % 50 != 24, F.col("o_totalprice"))}
    return [made[f.name].cast(f.dataType).alias(f.name) for f in schemas.ORDERS.fields]


def orders(spark: SparkSession, folder: str, region: bool = False) -> DataFrame:
    """Orders; the region costs three joins and is filled in only on request."""
    placed = read(spark, folder, "orders")
    if not region:
        return placed.select(*_order_columns())
    where = (read(spark, folder, "customer")
             .join(read(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
             .join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
             .select("c_custkey", "r_name"))
    return placed.join(where, F.col("o_custkey") == F.col("c_custkey")).select(*_order_columns(F.col("r_name")))


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return schemas.conform(read(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("item_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price")),
        schemas.ORDER_ITEMS)


def repeated_items(spark: SparkSession, folder: str) -> DataFrame:
    """Order items in which every item of an order number that ends in 7 comes twice."""
    items = order_items(spark, folder)
    return items.withColumn("_times", F.explode(F.sequence(
        F.lit(1), F.when(F.endswith("order_id", F.lit("7")), 2).otherwise(1)))).drop("_times")


def _dial() -> Column:
    """The number 0..99 in an event's props."""
    return F.get_json_object("props", "$.k").cast("int")


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Events as support incidents."""
    k, n = _dial(), F.col("event_id")
    events = read(spark, folder, "events")
    return schemas.conform(events.select(
        n.alias("incident_id"), F.col("user_id").alias("client_id"),
        F.col("ts").alias("report_date"), F.col("event_type").alias("category"),
        F.when(n % 10 < 7, n * 2).alias("order_id"),
        F.when(k < 60, "Resolved").when(k < 85, "In progress").when(k < 95, "Escalated")
        .otherwise("Closed").alias("status"),
        F.when(n % 10 < 3, "Low").when(n % 10 < 7, "Medium").when(n % 10 < 9, "High")
        .otherwise("Critical").alias("priority"),
        F.when(~k.between(60, 83), F.col("value")).alias("resolution_time_h")), schemas.INCIDENTS)


def page_views(spark: SparkSession, folder: str) -> DataFrame:
    k = _dial()
    return schemas.conform(read(spark, folder, "events").select(
        F.col("event_id").alias("session_id"),
        F.when(k < 80, F.col("user_id")).alias("client_id"),
        F.col("event_type").alias("page"), F.col("ts").alias("event_datetime"),
        F.col("value").alias("duration_seconds"),
        F.when(k < 55, "Mobile").when(k < 95, "Desktop").otherwise("Tablet").alias("device"),
        F.when(k % 5 < 3, "Chrome").when(k % 5 == 3, "Safari").otherwise("Opera").alias("browser"),
        F.when(k % 2 == 0, "Google").otherwise("Direct").alias("traffic_source")),
        schemas.PAGE_VIEWS)


def shop(spark: SparkSession, folder: str, region: bool = True) -> dict[str, DataFrame]:
    """All six tables by name."""
    return {
        "clients": clients(spark, folder),
        "products": products(spark, folder),
        "orders": orders(spark, folder, region),
        "order_items": order_items(spark, folder),
        "incidents": incidents(spark, folder),
        "page_views": page_views(spark, folder),
    }


def orders_with_product(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the least part number of their items as product_id, NULL without items.

    Items are grouped and joined on the order number itself, so the grouping serves the join; ids
    become text afterwards.
    """
    bought = (read(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
              .agg(F.min("l_partkey").cast("string").alias("product_id")))
    placed = read(spark, folder, "orders").join(bought, "o_orderkey", "left")
    return placed.select(*_order_columns(), "product_id")


def faulty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a shop might send them: some of unknown clients or products, some without a date,
    with a negative amount or a padded upper-case status."""
    k = F.col("order_id").cast("bigint")
    return orders_with_product(spark, folder).withColumns({
        "client_id": F.when(k % 97 == 13, "nobody").otherwise(F.col("client_id")),
        "product_id": F.when((k % 89 == 21) & F.col("product_id").isNotNull(), "nothing")
        .otherwise(F.col("product_id")),
        "order_date": F.when(k % 113 != 17, F.col("order_date")),
        "total_amount": F.when(k % 101 == 5, -F.col("total_amount")).otherwise(F.col("total_amount")),
        "status": F.when(k % 107 == 9, F.concat(F.lit(" \t"), F.upper("status"), F.lit("\n")))
        .otherwise(F.col("status"))})


def order_messages(spark: SparkSession, folder: str, placed: DataFrame | None = None, *kept: str) -> DataFrame:
    """The order stream as JSON text; some texts are cut off and some lack the product. Columns of
    ``placed`` may be kept beside the text."""
    value, key = F.col("value"), F.col("key").cast("bigint")
    sent = faulty_orders(spark, folder) if placed is None else placed
    return encode_events(sent, AS_OF, None, *kept).select(
        "key", *kept,
        F.when(key % 103 == 7, F.expr("left(value, length(value) - 3)"))
        .when(key % 109 == 11, F.replace(value, F.lit('"product_id"'), F.lit('"product"')))
        .otherwise(value).alias("value"))


def messages_by_year(spark: SparkSession, folder: str) -> Iterator[DataFrame]:
    """The order stream in order of date, one table per year; orders without a date come first. The
    years are those of the orders' first and last date. All messages are made and stored by one job,
    and a year reads its own files only."""
    path = scratch.new_folder(spark, "placed")
    placed = faulty_orders(spark, folder).withColumn("year", F.year("order_date"))
    sent = order_messages(spark, folder, placed, "year")
    sent.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    stored = spark.read.schema(sent.schema).parquet(path)
    ends = read(spark, folder, "orders").agg(
        F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")).first()
    year = F.col("year")
    for part in [year.isNull(), *(year == y for y in range(ends["first"] or 0, (ends["last"] or -1) + 1))]:
        yield stored.where(part).drop("year")


def write_by_year(spark: SparkSession, folder: str, path: str) -> None:
    """The order stream as files of about a range of years each, as many as the session's shuffles have
    partitions, joined and written by one job."""
    placed = faulty_orders(spark, folder).withColumn("year", F.year("order_date"))
    write_messages(order_messages(spark, folder, placed, "year").repartitionByRange("year", "key"), path)
