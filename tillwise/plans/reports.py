"""Sample queries and the figures of the summary report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tillwise.functions.numbers import exact_sum, round_to, share


def delivered_by_region(orders: DataFrame) -> DataFrame:
    """Delivered orders and their revenue by region, highest revenue first."""
    return (orders.filter(F.col("status") == "Delivered").groupBy("region")
            .agg(F.count("*").alias("orders"),
                 round_to(exact_sum("total_amount"), 2).alias("revenue"))
            .orderBy(F.desc("revenue")))


def top_customers(clients: DataFrame, orders: DataFrame, k: int = 10) -> DataFrame:
    """The k clients who spent most; clients without orders count as well. Ties by client_id."""
    who = (clients.groupBy("client_id", F.concat("first_name", F.lit(" "), "last_name")
                           .alias("name"), "country")
           .agg(F.count("*").alias("copies")))
    spent = orders.groupBy("client_id").agg(F.count("order_id").alias("n"),
                                            exact_sum("total_amount").alias("total"))
    return (who.join(spent, "client_id", "left")
            .select("client_id", "name", "country",
                    (F.coalesce("n", F.lit(0)) * F.col("copies")).alias("num_orders"),
                    round_to(F.col("total") * F.col("copies"), 2).alias("total_spent"))
            .orderBy(F.desc("total_spent"), "client_id").limit(k))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows of each table."""
    return reduce(DataFrame.unionByName, (
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()))


def country_distribution(clients: DataFrame) -> DataFrame:
    """Clients per country, most first; NULL is no country but counts in the total."""
    counted = clients.groupBy("country").agg(F.count("*").alias("nb_clients"))
    # The window sees one row per country.
    return (counted.withColumn("everyone", F.sum("nb_clients").over(Window.partitionBy()))
            .filter(F.col("country").isNotNull())
            .select("country", "nb_clients",
                    round_to(F.col("nb_clients") / F.col("everyone") * 100, 1).alias("pct"))
            .orderBy(F.desc("nb_clients"), "country"))


def total_revenue(orders: DataFrame) -> DataFrame:
    """Sum of all order amounts, NULL skipped."""
    return orders.agg(round_to(exact_sum("total_amount"), 2).alias("total_revenue"))


def delivery_rate(orders: DataFrame) -> DataFrame:
    """Delivered orders among all orders."""
    delivered = F.col("status") == "Delivered"
    return orders.agg(F.count_if(delivered).alias("delivered"), F.count("*").alias("orders"),
                      round_to(share(delivered) * 100, 1).alias("delivery_rate_pct"))


def resolution_rate(incidents: DataFrame) -> DataFrame:
    """Resolved incidents among all incidents."""
    resolved = F.col("status") == "Resolved"
    return incidents.agg(F.count_if(resolved).alias("resolved"), F.count("*").alias("incidents"),
                         round_to(share(resolved) * 100, 1).alias("resolution_rate_pct"))


def top_products_by_name(order_items: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """The k product names with most revenue; items of unknown products have no name and no
    place. Summed per product before the join. Ties by name."""
    per_product = order_items.groupBy("product_id").agg(
        exact_sum(F.col("quantity") * F.col("unit_price")).alias("total"))
    names = (products.filter(F.col("product_name").isNotNull())
             .groupBy("product_id", "product_name").agg(F.count("*").alias("listings")))
    revenue = exact_sum(F.col("total") * F.col("listings"))
    return (per_product.join(names, "product_id").groupBy("product_name")
            .agg(round_to(F.coalesce(revenue, F.lit(0.0)), 2).alias("revenue"))
            .orderBy(F.desc("revenue"), "product_name").limit(k))
