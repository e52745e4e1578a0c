"""Dimensions with one row per key, as the enrichment joins need them.

Store one (scratch.stored, or a table of your own) before joining: a stream then does not reduce it
again in every batch, its size is known when Spark chooses between broadcast and sort-merge, and,
being a plain scan, it lets adaptive execution split a hot key on the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the least by all other columns in order, NULL first.

    An aggregate, not a window, so copies of one key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
            .select(key, *(F.col(f"row.{c}").alias(c) for c in rest))
            .select(df.columns))


def client_dimension(clients: DataFrame) -> DataFrame:
    """client_id, name, email."""
    return first_per_key(
        clients.select("client_id", F.concat_ws(" ", "first_name", "last_name").alias("name"),
                       "email"),
        "client_id")


def product_dimension(products: DataFrame) -> DataFrame:
    """product_id, name, category."""
    return first_per_key(
        products.select("product_id", F.col("product_name").alias("name"), "category"),
        "product_id")
