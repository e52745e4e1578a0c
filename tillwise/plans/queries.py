"""Every runnable query by name: (spark, folder of the star-schema tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise import schemas, scratch
from tillwise.functions.domains import ACCEPTED
from tillwise.functions.times import iso_week
from tillwise.operators import dimensions as dim
from tillwise.operators import clean, enrich, metrics, quality
from tillwise.plans import catalog, reports, views
from tillwise.sources import batches, csv_files, landing, messages, star_schema as star, tables
from tillwise.streaming import finished, merged
from tillwise.streaming import orders as streams

Query = Callable[[SparkSession, str], DataFrame]

# Columns of enriched orders without the processing time.
UNION_COLUMNS = [f.name for f in schemas.CLEANED_ORDERS.fields if f.name != "processed_at"]
JOINED_COLUMNS = [f.name for f in schemas.ENRICHED_ORDERS.fields if f.name != "processed_at"]
METRIC_COLUMNS = ["client_id", "order_count", "total_revenue"]

# Bands for the star schema's own categories and pages.
TYPE_BANDS = {"ECONOMY": (900.0, 950.0), "SMALL": (920.0, 990.0), "LARGE": (900.0, 1500.0)}
EVENT_BANDS = {"view": (10.0, 60.0), "click": (1.0, 100.0), "purchase": (60.0, 600.0)}
NATION_REGION = {"NATION_1": "AMERICA", "NATION_2": "ASIA", "NATION_3": "EUROPE"}


# Views ------------------------------------------------------------------------------------------

def revenue_by_region(spark, folder):
    return views.revenue_by_region(star.orders(spark, folder, region=True),
                                   star.clients(spark, folder))


def inactive_clients(spark, folder):
    return views.inactive_clients(star.orders(spark, folder), star.clients(spark, folder),
                                  star.AS_OF)


def top_products(spark, folder):
    return views.top_products(star.order_items(spark, folder), star.products(spark, folder),
                              star.orders(spark, folder))


def recurring_incidents(spark, folder):
    return views.recurring_incidents(star.incidents(spark, folder))


def navigation_funnel(spark, folder):
    return views.navigation_funnel(star.page_views(spark, folder))


def _as_text(df, column):
    """Dates as text: clients hand out dates in different types."""
    return df.withColumn(column, F.col(column).cast("string"))


def weekly_kpis(spark, folder):
    return _as_text(views.weekly_kpis(star.orders(spark, folder)), "week")


def client_360(spark, folder):
    return views.client_360(star.clients(spark, folder), star.orders(spark, folder),
                            star.incidents(spark, folder),
                            star.page_views(spark, folder))


def sql_over_views(spark, folder):
    """SQL over the registered view names."""
    catalog.register(star.shop(spark, folder), star.AS_OF)
    return spark.sql("""
        SELECT s.client_segment, s.segment, count(*) AS nb_clients,
               count(i.client_id) AS nb_inactive, max(s.nb_orders) AS most_orders
        FROM v_client_360 s LEFT JOIN v_inactive_clients i ON s.client_id = i.client_id
        GROUP BY s.client_segment, s.segment""")


# Sample queries and report ----------------------------------------------------------------------

def delivered_by_region(spark, folder):
    return reports.delivered_by_region(star.orders(spark, folder, region=True))


def top_customers(spark, folder):
    return reports.top_customers(star.clients(spark, folder), star.orders(spark, folder))


def row_counts(spark, folder):
    return reports.row_counts(star.shop(spark, folder, region=False))


def country_distribution(spark, folder):
    return reports.country_distribution(star.clients(spark, folder))


def total_revenue(spark, folder):
    return reports.total_revenue(star.orders(spark, folder))


def delivery_rate(spark, folder):
    return reports.delivery_rate(star.orders(spark, folder))


def resolution_rate(spark, folder):
    return reports.resolution_rate(star.incidents(spark, folder))


def top5_products(spark, folder):
    return reports.top_products_by_name(star.order_items(spark, folder),
                                        star.products(spark, folder))


# Order messages: clean, enrich, measure ---------------------------------------------------------

def _cleaned(spark, folder):
    return clean.clean_orders(star.order_messages(spark, folder))


def _clients(spark, folder):
    return scratch.stored(spark, dim.client_dimension(star.clients(spark, folder)), "clients")


def _products(spark, folder):
    return scratch.stored(spark, dim.product_dimension(star.products(spark, folder)), "products")


def _dimensions(spark, folder):
    return _clients(spark, folder), _products(spark, folder)


def event_encode(spark, folder):
    return messages.encode_events(star.orders_with_product(spark, folder), sent_at=star.AS_OF)


def clean_orders(spark, folder):
    return _cleaned(spark, folder).drop("processed_at")


def rejected_orders(spark, folder):
    return clean.rejected_orders(star.order_messages(spark, folder))


def dimension_first(spark, folder):
    return dim.first_per_key(star.order_items(spark, folder), "item_id")


def orders_join_clients(spark, folder):
    return enrich.with_clients(_cleaned(spark, folder),
                               _clients(spark, folder)).drop("processed_at")


def orders_join_products(spark, folder):
    return enrich.with_products(_cleaned(spark, folder),
                                _products(spark, folder)).drop("processed_at")


def enriched_union(spark, folder):
    return enrich.enrich(_cleaned(spark, folder), *_dimensions(spark, folder),
                         form="union").select(UNION_COLUMNS)


def enriched_joined(spark, folder):
    return enrich.enrich(_cleaned(spark, folder), *_dimensions(spark, folder),
                         form="joined").select(JOINED_COLUMNS)


def client_metrics_union(spark, folder):
    return metrics.client_metrics(enrich.union_form(_cleaned(spark, folder),
                                                    *_dimensions(spark, folder)))


def client_metrics(spark, folder):
    return metrics.client_metrics(_joined(spark, folder))


def _joined(spark, folder):
    return enrich.joined_form(_cleaned(spark, folder), *_dimensions(spark, folder))


def client_metrics_windowed(spark, folder):
    return metrics.client_metrics_windowed(_joined(spark, folder))


def undated_orders(spark, folder):
    return metrics.undated(_joined(spark, folder)).select("order_id", "client_id", "reason")


# The same as streams, some files at a time -------------------------------------------------------

# Batches of a stream over a folder. A batch has fixed costs, so their number does not grow with the
# files; what a batch holds is shared by all tasks.
BATCHES = 4


def _a_batch(df):
    """Files that each of the batches takes."""
    return -(-len(df.inputFiles()) // BATCHES)


def _clean_stream(spark, folder, base, form):
    path = f"{base}/messages"
    star.write_by_year(spark, folder, path)
    streams.start_cleaning(
        messages.stream_messages(spark, path, _a_batch(messages.read_messages(spark, path))), *_dimensions(spark, folder),
        orders_path=f"{base}/orders", rejects_path=f"{base}/rejects", checkpoint=f"{base}/cleaning",
        form=form, available_now=True).awaitTermination()


def _enriched_stream(spark, folder, base):
    _clean_stream(spark, folder, base, "joined")
    found = streams.read_sink(spark, f"{base}/orders", schemas.ENRICHED_ORDERS)
    return streams.stream_sink(spark, f"{base}/orders", schemas.ENRICHED_ORDERS, _a_batch(found))


def stream_clean_orders(spark, folder):
    """Enriched orders and, with their reason, the messages set aside."""
    base = scratch.new_folder(spark, "clean")
    _clean_stream(spark, folder, base, "union")
    orders = streams.read_sink(spark, f"{base}/orders", schemas.CLEANED_ORDERS)
    rejects = streams.read_sink(spark, f"{base}/rejects", schemas.REJECTS)
    return orders.select(UNION_COLUMNS).unionByName(rejects.select("value", "reason"), allowMissingColumns=True)


def stream_client_metrics(spark, folder):
    base = scratch.new_folder(spark, "metrics")
    streams.start_metrics(
        _enriched_stream(spark, folder, base), metrics_path=f"{base}/metrics",
        checkpoint=f"{base}/checkpoint", available_now=True).awaitTermination()
    versions = streams.read_sink(spark, f"{base}/metrics", schemas.CLIENT_METRICS)
    return metrics.latest_metrics(versions).select(METRIC_COLUMNS)


def stream_windowed_metrics(spark, folder):
    """A year's messages are sent, cleaned and counted before the next year's: each of both streams
    takes all files of the year in one batch, however many there are."""
    base, late = scratch.new_folder(spark, "windows"), 0
    dimensions = _dimensions(spark, folder)
    for sent in star.messages_by_year(spark, folder):
        messages.write_messages(sent, f"{base}/messages")
        streams.start_cleaning(
            messages.stream_messages(spark, f"{base}/messages"), *dimensions, orders_path=f"{base}/orders",
            rejects_path=f"{base}/rejects", checkpoint=f"{base}/cleaning", form="joined",
            available_now=True).awaitTermination()
        query = streams.start_windowed_metrics(
            streams.stream_sink(spark, f"{base}/orders", schemas.ENRICHED_ORDERS), metrics_path=f"{base}/metrics",
            checkpoint=f"{base}/checkpoint", available_now=True)
        query.awaitTermination()
        late += streams.late_rows(query)  # a run has few batches, so Spark remembers them all
    if late:
        raise RuntimeError(f"{late} orders came behind the watermark")
    return streams.read_sink(spark, f"{base}/metrics", schemas.WINDOWED_METRICS).drop(
        "writer", "batch_id")


def stream_dedup_orders(spark, folder):
    """Every message sent twice; one of each order gets through."""
    base = scratch.new_folder(spark, "dedup")
    path = f"{base}/messages"
    for _ in range(2):
        messages.write_messages(star.order_messages(spark, folder).hint("rebalance"), path)
    once = quality.dedup_stream(
        clean.clean_orders(messages.stream_messages(spark, path, max_files=1)), ["order_id"])
    streams.start_appending(once, path=f"{base}/orders", checkpoint=f"{base}/checkpoint",
                            available_now=True).awaitTermination()
    return streams.read_sink(spark, f"{base}/orders", once.schema).drop(
        "processed_at", "writer", "batch_id")


# Streams over tables of finished batches --------------------------------------------------------

def _sent(spark, folder, base, delayed=False):
    """The order stream as finished batches, one per year of order, written by one job; undated orders
    come first. ``delayed``: every eleventh order comes a year late."""
    placed = star.faulty_orders(spark, folder).withColumn("year", F.year("order_date"))
    late = F.when(F.col("order_id").cast("bigint") % 11 == 4, 1).otherwise(0) if delayed else F.lit(0)
    number = F.coalesce(F.col("year") - star.FIRST_YEAR + 1 + late, F.lit(0))
    sent = star.order_messages(spark, folder, placed.withColumn("number", number), "number").drop("key")
    batches.append_by(sent, f"{base}/messages", "shop", "number")


def _followed(spark, folder, base, form="joined", delayed=False):
    """Messages to the table of enriched orders; its path."""
    _sent(spark, folder, base, delayed)
    for name, df in (("clients", dim.client_dimension(star.clients(spark, folder))),
                     ("products", dim.product_dimension(star.products(spark, folder)))):
        finished.publish(df, f"{base}/{name}")
    finished.start_cleaning(
        spark, f"{base}/messages", f"{base}/clients", f"{base}/products", orders_path=f"{base}/orders",
        rejects_path=f"{base}/rejects", checkpoint=f"{base}/cleaning", form=form, available_now=True).awaitTermination()
    return f"{base}/orders"


def stream_finished_batches(spark, folder):
    """Enriched orders and rejects of the batches that are finished, after their files were put
    together; a batch that is half written is not among them."""
    base = scratch.new_folder(spark, "finished")
    orders = _followed(spark, folder, base, "union")
    batches.compact(spark, orders, schemas.CLEANED_ORDERS, together=4)
    found = batches.read(spark, orders, schemas.CLEANED_ORDERS)
    found.withColumn("order_id", F.lit("half")).write.parquet(f"{orders}/cleaning-99")
    rejects = batches.read(spark, f"{base}/rejects", schemas.REJECTS)
    return batches.read(spark, orders, schemas.CLEANED_ORDERS).select(UNION_COLUMNS).unionByName(
        rejects.select("value", "reason"), allowMissingColumns=True)


def stream_client_totals(spark, folder):
    """Running totals merged batch by batch into one snapshot."""
    base = scratch.new_folder(spark, "totals")
    finished.start_totals(spark, _followed(spark, folder, base), path=f"{base}/totals", checkpoint=f"{base}/checkpoint",
                          buckets=int(spark.conf.get("spark.sql.shuffle.partitions")), available_now=True).awaitTermination()
    return merged.client_totals(spark, f"{base}/totals")


def stream_late_orders(spark, folder):
    """Windows, closed and open, of orders of which some come a year late, and the orders that none of
    them counts."""
    base = scratch.new_folder(spark, "late")
    finished.start_windows(spark, _followed(spark, folder, base, delayed=True), path=f"{base}/windows",
                           checkpoint=f"{base}/checkpoint", available_now=True).awaitTermination()
    windows = finished.windows_of(spark, f"{base}/windows").withColumn(
        "kind", F.when(F.col("closed"), "closed").otherwise("open")).drop("closed", "window_end")
    others = finished.left_out(spark, f"{base}/windows").select(F.col("reason").alias("kind"), "order_id", "client_id")
    return windows.unionByName(others, allowMissingColumns=True)


def stream_distinct_counts(spark, folder):
    """Unique users per page and active clients per week, exactly and whether the streams' sketches
    are within their error of it, over many batches and over one."""
    base, parts = scratch.new_folder(spark, "distinct"), []
    views_seen = star.page_views(spark, folder).withColumn("number", F.dayofmonth("event_datetime") % 6)
    placed = star.orders(spark, folder).where("status <> 'Cancelled'").withColumn("number", F.year("order_date") - star.FIRST_YEAR)
    for name, rows, group in (("page", views_seen, F.col("page")),
                              ("week", placed, iso_week("order_date").cast("string"))):
        schema = rows.drop("number").schema
        batches.append_by(rows, f"{base}/{name}/many", "shop", "number")
        batches.append_by(rows.withColumn("number", F.lit(0)), f"{base}/{name}/one", "shop", "number")
        exact = (rows.groupBy(group.alias("group_value")).agg(F.countDistinct("client_id").alias("distinct_values")))
        for way in ("many", "one"):
            path = f"{base}/{name}/{way}-sketches"
            finished.start_distinct(spark, f"{base}/{name}/{way}", schema, group={"group_value": group}, value="client_id",
                                    path=path, checkpoint=f"{base}/{name}/{way}-checkpoint", available_now=True).awaitTermination()
            found = finished.distinct_counts(spark, path, "group_value string", way)
            exact = exact.join(found, "group_value", "left")
        close = [(F.abs(F.col(way) - F.col("distinct_values")) <= finished.ERROR * F.col("distinct_values")).alias(f"close_in_{way}")
                 for way in ("many", "one")]
        parts.append(exact.select(F.lit(name).alias("measure"), "group_value", "distinct_values", *close))
    return reduce(DataFrame.unionByName, parts)


# Sources, sinks, tables -------------------------------------------------------------------------

# Parts by hash in which two tables are compared.
SLICES = 1024


def _changes(before, after, name):
    """Rows of a table and rows that a round trip has lost, added or altered.

    Per slice, rows are counted and two 64-bit hashes of them summed up, so slices whose rows all came
    back are told without a shuffle of rows. Rows of the other slices are compared in full.
    """
    columns, hashes = before.columns, ("_hash", "_other")
    # A hash passes over nulls, so where they stand goes in as well.
    row = [*columns, *map(F.isnull, columns)]
    both = (before.withColumn("_sign", F.lit(1)).unionByName(after.select(columns).withColumn("_sign", F.lit(-1)))
            .withColumns({"_hash": F.xxhash64(*row), "_other": F.xxhash64(F.lit(name), *row)})
            .withColumn("_slice", F.pmod("_hash", F.lit(SLICES))))
    # Hashes are summed up by halves: a bigint holds the sums of 2^31 rows of a slice.
    halves = [half for h in map(F.col, hashes) for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftright(h, 32))]
    left = {"_left": F.sum("_sign")} | {f"_sum{i}": F.sum(F.col("_sign") * half) for i, half in enumerate(halves)}
    slices = scratch.stored(before.sparkSession, both.groupBy("_slice").agg(
        F.count_if(F.col("_sign") == 1).alias("_rows"), *(of.alias(to) for to, of in left.items())), "slices")
    rows = slices.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"))
    differing = slices.where(" OR ".join(f"{to} <> 0" for to in left)).select("_slice")
    if differing.isEmpty():
        return rows.withColumn("n_changed", F.lit(0).cast("bigint"))
    per_row = (both.join(F.broadcast(differing), "_slice", "left_semi")
               .groupBy(columns).agg(F.sum("_sign").alias("_left")))
    return rows.crossJoin(per_row.agg(F.coalesce(F.sum(F.abs("_left")), F.lit(0)).alias("n_changed")))


def _side_by_side(round_trip, shop):
    """What a round trip of every table has changed; a small table does not wait for a large one."""
    with ThreadPoolExecutor(landing.SIDE_BY_SIDE) as pool:
        return reduce(DataFrame.unionByName, list(pool.map(round_trip, shop.values(), shop)))


def csv_roundtrip(spark, folder):
    path = scratch.new_folder(spark, "csv")
    csv_files.write_csv(star.clients(spark, folder), path)
    return csv_files.load_csv(spark, schemas.CLIENTS, path)


def csv_roundtrip_all(spark, folder):
    """All six tables through CSV, compared row by row."""
    base = scratch.new_folder(spark, "csv")

    def round_trip(df, name):
        path = f"{base}/{name}.csv"
        csv_files.write_csv(df, path)
        return _changes(df, csv_files.load_csv(spark, schemas.TABLES[name], path), name)

    return _side_by_side(round_trip, star.shop(spark, folder))


def csv_split_quoted(spark, folder):
    """Clients with line breaks and quotes in their names, through CSV files that any number of tasks
    may share."""
    path = scratch.new_folder(spark, "csv")
    k = F.col("client_id").cast("bigint")
    odd = F.when(k % 3 == 0, F.concat(F.lit('a "b"\n,'), "last_name", F.lit('\n\n"'))).otherwise(F.col("last_name"))
    csv_files.write_csv(star.clients(spark, folder).withColumn("last_name", odd), path)
    return csv_files.load_csv_split(spark, schemas.CLIENTS, path)


def csv_rejects(spark, folder):
    """Products of which some have a word for a price: what the typed load sets aside."""
    path = scratch.new_folder(spark, "csv")
    price = F.when(F.col("product_id").cast("bigint") % 20 == 3, "cheap").otherwise(F.col("unit_price").cast("string"))
    csv_files.write_csv(star.products(spark, folder).withColumn("unit_price", price), path)
    _, rejects = csv_files.load_csv_with_rejects(spark, schemas.PRODUCTS, path)
    return rejects


def positional_csv(spark, folder):
    """Clients and products by position, with the rejects of both."""
    base, parts = scratch.new_folder(spark, "csv"), []
    named = {"clients": ("client_id", "name", "email"), "products": ("product_id", "name", "category")}
    for name, names in named.items():
        csv_files.write_csv(star.shop(spark, folder)[name], f"{base}/{name}")
        rows, rejects = csv_files.load_by_position(spark, f"{base}/{name}", list(names),
                                                   width=len(schemas.TABLES[name]))
        parts += [rows.toDF("key", "second", "third").withColumn("kind", F.lit(name)),
                  rejects.select(F.lit(None).cast("string").alias("key"), F.col("value").alias("second"),
                                 F.col("reason").alias("third"), F.lit("rejects").alias("kind"))]
    return reduce(DataFrame.unionByName, parts)


def partitioned_roundtrip(spark, folder):
    path = scratch.new_folder(spark, "page_views")
    tables.write_table(star.page_views(spark, folder), "page_views", path)
    return _as_text(tables.read_table(spark, "page_views", path), "day")


def partitioned_roundtrip_all(spark, folder):
    """Every table through its layout, compared row by row."""
    base = scratch.new_folder(spark, "lake")

    def round_trip(df, name):
        path = f"{base}/{name}"
        tables.write_table(df, name, path)
        return _changes(df, tables.read_table(spark, name, path), name)

    return _side_by_side(round_trip, star.shop(spark, folder))


def catalog_tables(spark, folder):
    """Create and load the six tables, read all of them by name, and drop the database."""
    base = scratch.new_folder(spark, "shop")
    database = "shop_" + base.rsplit("-", 1)[1]
    tables.create_tables(spark, database, base)
    try:
        for name, df in star.shop(spark, folder).items():
            tables.load_table(spark, database, name, df)
        found = spark.sql(f"""
            SELECT c.country, count(*) AS nb_orders, sum(i.n_items) AS nb_items,
                   sum(i.n_products) AS nb_products, max(n.nb_incidents) AS most_incidents,
                   max(v.nb_days) AS most_days
            FROM {database}.orders o JOIN {database}.clients c ON o.client_id = c.client_id
            LEFT JOIN (SELECT order_id, count(*) AS n_items, count(p.product_id) AS n_products
                       FROM {database}.order_items t LEFT JOIN {database}.products p
                       ON t.product_id = p.product_id GROUP BY order_id) i ON o.order_id = i.order_id
            LEFT JOIN (SELECT client_id, count(*) AS nb_incidents FROM {database}.incidents
                       GROUP BY client_id) n ON o.client_id = n.client_id
            LEFT JOIN (SELECT client_id, count(DISTINCT day) AS nb_days FROM {database}.page_views
                       GROUP BY client_id) v ON o.client_id = v.client_id
            GROUP BY c.country""")
        return scratch.stored(spark, found, "by_country")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def catalog_replace(spark, folder):
    """Page views and clients by name after a good load, after one that failed half-way, and after a
    second good one."""
    base = scratch.new_folder(spark, "shop")
    database = "shop_" + base.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    steps = []
    try:
        for table, rows in (("page_views", star.page_views(spark, folder)), ("clients", star.clients(spark, folder))):
            key = rows.columns[0]
            some = rows.where(F.col(key).cast("bigint") % 5 == 0)
            broken = rows.withColumn(key, F.when(F.col(key).cast("bigint") % 7 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col(key)))
            for step, load in (("first", some), ("failed", broken), ("second", rows)):
                try:
                    tables.replace_table(spark, database, base, table, load)
                except PySparkException as failed:
                    if step != "failed" or "lost" not in str(failed):
                        raise
                seen = spark.table(f"{database}.{table}").agg(
                    F.count("*").alias("n_rows"), F.sum(F.col(key).cast("bigint")).alias("keys"))
                steps.append(scratch.stored(spark, seen.select(
                    F.lit(table).alias("table_name"), F.lit(step).alias("step"), "n_rows", "keys"), "seen"))
        return reduce(DataFrame.unionByName, steps)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def landing_manifest(spark, folder):
    """All six tables, one that the data model does not know and one without rows to CSV, landed
    as Parquet; the manifest per table."""
    source, zone = scratch.new_folder(spark, "csv"), scratch.new_folder(spark, "raw")
    regions = star.read(spark, folder, "region")
    landing.write_folder({**star.shop(spark, folder), "regions": regions,
                          "returns": regions.where("false")}, source)
    return (landing.land_folder(spark, source, zone).groupBy("table_name")
            .agg(F.sum("n_rows").alias("n_rows"), F.count_if(F.col("source_bytes") <= 0).alias("empty_files")))


# Data quality -----------------------------------------------------------------------------------

def null_profile(spark, folder):
    shop = star.shop(spark, folder)
    profiles = [quality.null_profile(df, name) for name, df in shop.items()]
    result = profiles[0]
    for profile in profiles[1:]:
        result = result.unionByName(profile)
    return result


def duplicate_rows(spark, folder):
    return quality.duplicate_rows(star.repeated_items(spark, folder))


def dedup_rows(spark, folder):
    return quality.dedup_rows(star.repeated_items(spark, folder))


def email_check(spark, folder):
    return quality.email_check(star.clients(spark, folder))


def age_check(spark, folder):
    return quality.age_check(star.clients(spark, folder))


def ref_integrity(spark, folder):
    shop = star.shop(spark, folder, region=False)
    return quality.ref_integrity({
        "orders.client_id": (shop["orders"], shop["clients"], "client_id"),
        "order_items.order_id": (shop["order_items"], shop["orders"], "order_id"),
        "order_items.product_id": (shop["order_items"], shop["products"], "product_id"),
        "incidents.client_id": (shop["incidents"], shop["clients"], "client_id"),
        "incidents.order_id": (shop["incidents"], shop["orders"], "order_id"),
    })


def order_total_check(spark, folder):
    return quality.order_total_check(star.orders(spark, folder), star.order_items(spark, folder))


def date_order_check(spark, folder):
    return quality.date_order_check(star.orders(spark, folder), star.clients(spark, folder),
                                    "order_id", "order_date")


def incident_date_check(spark, folder):
    return quality.date_order_check(star.incidents(spark, folder), star.clients(spark, folder),
                                    "incident_id", "report_date")


def mend_ages(spark, folder):
    return quality.mend_ages(star.clients(spark, folder)).select("client_id", "age")


def segment_rule(spark, folder):
    return quality.segment_rule(star.clients(spark, folder), star.AS_OF)


def region_lookup(spark, folder):
    return quality.region_check(star.orders(spark, folder, region=True),
                                star.clients(spark, folder), NATION_REGION)


def resolution_rule(spark, folder):
    return quality.resolution_rule(star.incidents(spark, folder))


def price_band_check(spark, folder):
    return quality.price_band_check(star.order_items(spark, folder),
                                    star.products(spark, folder))


def catalogue_band_check(spark, folder):
    return quality.catalogue_band_check(star.products(spark, folder), TYPE_BANDS)


def duration_band_check(spark, folder):
    return quality.duration_band_check(star.page_views(spark, folder), EVENT_BANDS)


def accepted_values(spark, folder):
    shop = star.shop(spark, folder, region=False)
    checks = [quality.accepted_values(shop[name], name) for name in ACCEPTED]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def seeded_sample(spark, folder):
    return quality.seeded_sample(star.order_items(spark, folder), ["item_id", "order_id", "product_id"])


def drawn_sample(spark, folder):
    return quality.drawn_sample(star.repeated_items(spark, folder), ["item_id", "order_id", "product_id"])


ALL: tuple[Query, ...] = (
    revenue_by_region, inactive_clients, top_products, recurring_incidents, navigation_funnel,
    weekly_kpis, client_360, sql_over_views,
    delivered_by_region, top_customers, row_counts, country_distribution, total_revenue,
    delivery_rate, resolution_rate, top5_products,
    event_encode, clean_orders, rejected_orders, dimension_first, orders_join_clients,
    orders_join_products, enriched_union, enriched_joined, client_metrics_union, client_metrics,
    client_metrics_windowed, undated_orders,
    stream_clean_orders, stream_client_metrics, stream_windowed_metrics, stream_dedup_orders,
    stream_finished_batches, stream_client_totals, stream_late_orders, stream_distinct_counts,
    csv_roundtrip, csv_roundtrip_all, csv_rejects, positional_csv, partitioned_roundtrip,
    partitioned_roundtrip_all, catalog_tables, landing_manifest,
    null_profile, duplicate_rows, dedup_rows, email_check, age_check, ref_integrity,
    order_total_check, date_order_check, incident_date_check, mend_ages, segment_rule, region_lookup, resolution_rule,
    price_band_check, catalogue_band_check, duration_band_check, accepted_values, seeded_sample,
    drawn_sample, csv_split_quoted, catalog_replace,
)
