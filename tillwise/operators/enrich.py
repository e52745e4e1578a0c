"""Joins of cleaned orders, batch or stream, with the client and product dimensions.

No broadcast hints: Spark broadcasts a dimension while its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.schemas import CLEANED_ORDERS, ENRICHED_ORDERS, conform


def with_clients(orders: DataFrame, clients: DataFrame) -> DataFrame:
    """Orders of known clients, with the client's name and e-mail."""
    return orders.join(clients, "client_id", "inner")


def with_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders of known products, with the product's name and category."""
    return orders.join(products, "product_id", "inner")


def union_form(orders: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """Orders joined with clients and orders joined with products, one below the other: an order
    that matches both comes twice, once with the client's name and once with the product's.

    Both matches are attached to the order in one pass and then unfolded, so the orders (and with
    them their messages) are read once and not once per branch.
    """
    none = F.lit(None).cast("string")
    by_client = F.struct("name", "email", none.alias("category")).alias("by_client")
    by_product = F.struct("name", none.alias("email"), "category").alias("by_product")
    matched = (orders.join(clients.select("client_id", by_client), "client_id", "left")
               .join(products.select("product_id", by_product), "product_id", "left"))
    return (matched
            .withColumn("match", F.explode(F.array_compact(F.array("by_client", "by_product"))))
            .select(*orders.columns, "match.*"))


def joined_form(orders: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order with client and product side by side."""
    goods = products.withColumnRenamed("name", "product_name")
    return with_products(with_clients(orders, clients), goods)


FORMS = {"union": (union_form, CLEANED_ORDERS), "joined": (joined_form, ENRICHED_ORDERS)}


def enrich(orders: DataFrame, clients: DataFrame, products: DataFrame,
           form: str = "union") -> DataFrame:
    """Enriched orders in the columns and types of their sink table."""
    join, schema = FORMS[form]
    return conform(join(orders, clients, products), schema)
