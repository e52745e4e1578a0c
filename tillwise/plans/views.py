"""The seven standing business views.

Tables hold raw data: rows may be repeated and statuses may be NULL, and a view counts what it is
given. Where a join would multiply repeated rows, the smaller side is first reduced to distinct rows
with a count of copies; sums are then weighted with it, which gives the multiplied result without
ever building the pairs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from tillwise.functions.numbers import exact_sum, mean, round_to, share
from tillwise.functions.times import iso_week, moment, whole_days
from tillwise.operators.ranking import rank_within
from tillwise.operators.skew import join_per_key


def _not_cancelled(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") != "Cancelled")  # drops NULL status as well


def revenue_by_region(orders: DataFrame, clients: DataFrame) -> DataFrame:
    """Orders, revenue, average basket and share of all revenue by country, region and month."""
    homes = clients.groupBy("client_id", "country").agg(F.count("*").alias("copies"))
    sold = _not_cancelled(orders).select(
        "client_id", "order_id", "region", "total_amount",
        F.date_trunc("month", "order_date").alias("month"))
    amount, copies = F.col("total_amount"), F.col("copies")
    by_month = (
        sold.join(homes, "client_id").groupBy("country", "region", "month")
        .agg(F.countDistinct("order_id").alias("nb_orders"),
             exact_sum(amount, copies).alias("total"),
             mean(amount, copies).alias("basket")))
    # The window sees one row per country, region and month, not the orders.
    whole = F.sum("total").over(Window.partitionBy())
    return by_month.withColumn("whole", whole).select(
        "country", "region", "month", "nb_orders",
        round_to("total", 2).alias("revenue"),
        round_to("basket", 2).alias("avg_basket"),
        round_to(F.try_divide("total", "whole"), 4).alias("pct_global_revenue"))


def inactive_clients(orders: DataFrame, clients: DataFrame,
                     as_of: datetime | str | None = None, days: int = 60) -> DataFrame:
    """Clients whose last order is more than ``days`` whole days ago, best customers first."""
    last_order = (
        _not_cancelled(orders).groupBy("client_id")
        .agg(F.max("order_date").alias("last_order_date"),
             F.count("order_id").alias("nb_orders"),
             round_to(exact_sum("total_amount"), 2).alias("historical_revenue"))
        .withColumn("days_inactive", whole_days("last_order_date", moment(as_of)))
        .filter(F.col("days_inactive") > days))
    who = clients.select("client_id", "first_name", "last_name", "email", "country", "segment")
    return (join_per_key(who, last_order, "client_id")
            .select(*who.columns, "last_order_date", "days_inactive", "nb_orders",
                    "historical_revenue")
            .orderBy(F.desc("historical_revenue")))


def top_products(order_items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales, cancellation rate and rank within the category, per product.

    Products are ranked in narrow bands of revenue, so no category is one task; the second use of
    the figures reads the same shuffles again. Orders are grouped on the key of the join. An order's
    items lie together, sorted by product, and the first of each product counts the order: no task
    holds pairs of product and order in a table of its memory, as a distinct count would.
    """
    statuses = orders.groupBy("order_id").agg(
        F.count("*").alias("copies"),
        F.count_if(F.col("status") == "Cancelled").alias("cancelled_copies"))
    quantity, price, copies = F.col("quantity"), F.col("unit_price"), F.col("copies")
    pair = Window.partitionBy("order_id", "product_id").orderBy("order_id", "product_id")
    items = (order_items.select("order_id", "product_id", "quantity", "unit_price")
             .where("order_id IS NOT NULL AND product_id IS NOT NULL")  # neither join finds these
             .repartition("order_id").withColumn("place", F.row_number().over(pair)))
    sales = (
        items.join(statuses.hint("merge"), "order_id").groupBy("product_id")
        .agg(F.count_if(F.col("place") == 1).alias("nb_orders"),
             exact_sum(quantity, copies).alias("quantity"),
             exact_sum(quantity * price, copies).alias("total"),
             mean(price, copies).alias("price"),
             (F.sum("cancelled_copies") / F.sum(copies)).alias("cancelled")))
    # Joined only now: one row per product instead of one per item.
    catalogue = (products.groupBy("product_id", "product_name", "category")
                 .agg(F.count("*").alias("listings")))
    figures = catalogue.join(sales, "product_id").select(
        "product_id", "product_name", "category", "nb_orders",
        (F.col("quantity") * F.col("listings")).alias("qty_sold"),
        (F.col("total") * F.col("listings")).alias("total"), "price", "cancelled")
    return rank_within(figures, "category", "total", "place").select(
        "product_id", "product_name", "category", "nb_orders", "qty_sold",
        round_to("total", 2).alias("revenue"),
        round_to("price", 2).alias("avg_price"),
        round_to("cancelled", 4).alias("cancellation_rate"),
        F.col("place").cast("bigint").alias("rank_in_category"))


def recurring_incidents(incidents: DataFrame) -> DataFrame:
    """Number, resolution time and outcome of incidents by category."""
    return incidents.groupBy("category").agg(
        F.count("*").alias("nb_incidents"),
        round_to(mean("resolution_time_h"), 1).alias("avg_resolution_h"),
        round_to(share(F.col("status") == "Escalated"), 4).alias("pct_escalated"),
        round_to(share(F.col("priority") == "Critical"), 4).alias("pct_critical"),
        round_to(share(F.col("status") == "Resolved"), 4).alias("resolution_rate"))


def navigation_funnel(page_views: DataFrame) -> DataFrame:
    """Traffic, time spent and devices by page; nb_sessions counts rows."""
    duration = mean("duration_seconds")
    return page_views.groupBy("page").agg(
        F.count("*").alias("nb_sessions"),
        F.countDistinct("client_id").alias("unique_users"),
        round_to(duration, 1).alias("avg_duration_s"),
        round_to(share(F.col("device") == "Mobile"), 4).alias("pct_mobile"),
        round_to(share(F.col("device") == "Desktop"), 4).alias("pct_desktop"),
        round_to(duration * F.count("*") / 1000, 2).alias("engagement_score"))


def weekly_kpis(orders: DataFrame) -> DataFrame:
    """Orders, revenue, active clients and growth over the week before, by ISO week."""
    weekly = (
        _not_cancelled(orders).groupBy(iso_week("order_date").alias("week"))
        .agg(F.countDistinct("order_id").alias("nb_orders"),
             round_to(exact_sum("total_amount"), 2).alias("revenue"),
             F.countDistinct("client_id").alias("active_clients")))
    # The window sees one row per calendar week, not the orders.
    before = F.lag("revenue").over(Window.orderBy("week"))
    growth = F.try_divide(F.col("revenue") - F.col("prev_week_revenue"), "prev_week_revenue") * 100
    return (weekly.withColumn("prev_week_revenue", before)
            .withColumn("growth_pct", round_to(growth, 2))
            .select("week", "nb_orders", "revenue", "active_clients", "prev_week_revenue",
                    "growth_pct")
            .orderBy("week"))


def client_360(clients: DataFrame, orders: DataFrame, incidents: DataFrame,
               page_views: DataFrame) -> DataFrame:
    """One row per client row: orders, incidents, page views, value score and segment.

    Orders, incidents and page views are stacked and aggregated together, so their per-client
    figures cost one shuffle and one join instead of three.
    """
    facts = (
        _not_cancelled(orders)
        .select("client_id", "order_id", "total_amount", "order_date", F.lit("order").alias("kind"))
        .unionByName(incidents.select("client_id", F.lit("incident").alias("kind")),
                     allowMissingColumns=True)
        .unionByName(page_views.select("client_id", F.lit("view").alias("kind")),
                     allowMissingColumns=True)
        .filter(F.col("client_id").isNotNull()))
    stats = facts.groupBy("client_id").agg(
        F.countDistinct("order_id").alias("nb_orders"),
        round_to(exact_sum("total_amount"), 2).alias("total_revenue"),
        round_to(mean("total_amount"), 2).alias("avg_basket"),
        F.max("order_date").alias("last_order_date"),
        F.count_if(F.col("kind") == "incident").alias("nb_incidents"),
        F.count_if(F.col("kind") == "view").alias("nb_pageviews"))
    who = clients.select("client_id", "first_name", "last_name", "country", "segment",
                         "registration_date")
    figures = join_per_key(who, stats, "client_id", "left").select(
        *who.columns, "last_order_date",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("nb_orders", "nb_incidents", "nb_pageviews")),
        *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("total_revenue", "avg_basket")))
    worth = F.col("total_revenue") * 0.5 + F.col("nb_orders") * 2
    # NULL without incidents, as the term divides by their number; the segment leaves it out.
    score = (F.col("total_revenue") * 0.5
             + F.try_divide(F.lit(1), F.col("nb_incidents")) * 20
             + F.col("nb_orders") * 2)
    return figures.select(
        *who.columns, "nb_orders", "total_revenue", "avg_basket", "last_order_date",
        "nb_incidents", "nb_pageviews", round_to(score, 2).alias("value_score"),
        F.when(worth > 200, "VIP").when(worth > 50, "Regular").otherwise("At risk")
        .alias("client_segment"))
