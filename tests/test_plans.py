"""What the plans must and must not hold, so that they carry over to large tables."""

import __spark_entry__ as contract
import pytest
from pyspark.sql import functions as F
from rows import client, order, table

from tillwise.plans import queries as registry, reports, views
from tillwise.schemas import TABLES
from tillwise.sources import star_schema

FOLDER = "/root/testdata/sf0.001"
# These write and run streams while they are built; their parts are checked by the others.
EAGER = {"stream_clean_orders", "stream_client_metrics", "stream_windowed_metrics", "stream_dedup_orders",
         "catalog_tables", "landing_manifest", "csv_roundtrip", "positional_csv",
         "stream_finished_batches", "stream_client_totals", "stream_late_orders", "stream_distinct_counts",
         "csv_split_quoted", "catalog_replace",
         "partitioned_roundtrip", "csv_roundtrip_all", "partitioned_roundtrip_all", "csv_rejects"}


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)
    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted({query.__name__ for query in registry.ALL} - EAGER))
def test_no_pairs_and_no_python_rows(spark, settings, name):
    settings(autoBroadcastJoinThreshold="-1")
    plan = executed(contract.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas",
                     "MapInArrow", "CollectLimit", "collect_list", "collect_set"):
        assert operator not in plan, operator


@pytest.fixture
def stored(spark, tmp_path):
    """The shop's tables as typed Parquet."""
    shop = star_schema.shop(spark, FOLDER)
    for name in ("orders", "order_items", "products", "page_views"):
        shop[name].write.parquet(f"{tmp_path}/{name}")
    return lambda name: spark.read.schema(TABLES[name]).parquet(f"{tmp_path}/{name}")


def test_filters_and_columns_reach_the_scan(spark, stored):
    plan = executed(reports.delivered_by_region(stored("orders")))
    assert "EqualTo(status,Delivered)" in plan
    assert "ReadSchema: struct<status:string,region:string,total_amount:double>" in plan


def test_cancelled_orders_are_left_out_by_the_scan(spark, stored):
    plan = executed(views.weekly_kpis(stored("orders")))
    assert "Not(EqualTo(status,Cancelled))" in plan and "payment_method" not in plan


def test_views_read_only_what_they_need(spark, stored):
    plan = executed(views.navigation_funnel(stored("page_views")))
    assert ("ReadSchema: struct<client_id:string,page:string,duration_seconds:double,device:string>"
            in plan)


def test_top_customers_sorts_only_for_the_top(spark, stored):
    shop = star_schema.shop(spark, FOLDER)
    assert "TakeOrderedAndProject(limit=10" in executed(
        reports.top_customers(shop["clients"], stored("orders")))


def test_sums_are_partial_before_the_shuffle(spark, stored):
    plan = executed(reports.delivered_by_region(stored("orders")))
    assert plan.index("Exchange hashpartitioning(region") < plan.index("partial_sum")


def test_hot_client_is_split_by_adaptive_execution(spark, settings):
    """One client with a third of all orders: the join splits its partition, the result stays."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
             adaptive__skewJoin__skewedPartitionFactor="2",
             adaptive__advisoryPartitionSizeInBytes="20KB")
    n = F.col("id")
    many = spark.range(0, 30_000, 1, 6).select(
        n.cast("string").alias("order_id"),
        F.when(n % 3 == 0, "hot").otherwise((n % 997).cast("string")).alias("client_id"),
        F.lit("2024-01-01").cast("timestamp").alias("order_date"), F.lit("Delivered").alias("status"),
        F.lit("EU").alias("region"), (n % 100).cast("double").alias("total_amount"))
    clients = many.select("client_id", F.lit("France").alias("country")).distinct()
    result = views.revenue_by_region(many, clients)
    [row] = result.collect()
    assert (row.nb_orders, row.revenue) == (30_000, 30_000 * 49.5)
    assert "SortMergeJoin(skew=true)" in executed(result)


def test_copies_do_not_multiply_in_the_join(spark):
    """A client listed often with an order listed often: weighted, never paired."""
    orders = table(spark, "orders", order("1", "a", 1.0)).crossJoin(spark.range(20_000)).drop("id")
    clients = table(spark, "clients", client("a")).crossJoin(spark.range(20_000)).drop("id")
    [row] = views.revenue_by_region(orders, clients).collect()
    assert (row.nb_orders, row.revenue) == (1, 20_000.0 ** 2)
    [top] = reports.top_customers(clients, orders).collect()
    assert (top.num_orders, top.total_spent) == (20_000 ** 2, 20_000.0 ** 2)


def test_registering_views_runs_no_job(spark):
    from tillwise.plans import catalog
    from tillwise.sources import star_schema

    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    catalog.register(star_schema.shop(spark, "/root/testdata/sf0.001"), star_schema.AS_OF)
    assert set(tracker.getJobIdsForGroup(None)) == before
