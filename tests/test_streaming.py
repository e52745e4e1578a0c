"""The streams give what the batch gives, in one batch or many, and after a restart."""

import json
import os

import pytest
from pyspark.sql import functions as F
from rows import client, product, table

from tillwise import schemas, scratch
from tillwise.operators import clean, dimensions, enrich, metrics, quality
from tillwise.sources import messages
from tillwise.streaming import orders as streams


def body(i: int, **change) -> str:
    return json.dumps({
        "order_id": f"o{i}", "client_id": f"c{i % 3}", "product_id": f"p{i % 2}",
        "total_amount": i + 0.25, "status": "Delivered",
        "order_date": f"2024-05-01 10:{i % 60:02d}:00", **change})


@pytest.fixture
def dims(spark):
    clients = table(spark, "clients", client("c0"), client("c1"), client("c1"))
    products = table(spark, "products", product("p0"), product("p1"))
    return (scratch.stored(spark, dimensions.client_dimension(clients), "clients"),
            scratch.stored(spark, dimensions.product_dimension(products), "products"))


def put(tmp_path, name: str, *texts: str) -> None:
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def stream(spark, tmp_path, max_files=None):
    return messages.stream_messages(spark, str(tmp_path / "in"), max_files)


def clean_run(spark, tmp_path, dims, max_files=None, checkpoint="check", form="union"):
    streams.start_cleaning(
        stream(spark, tmp_path, max_files), *dims, orders_path=f"{tmp_path}/orders",
        rejects_path=f"{tmp_path}/rejects", checkpoint=f"{tmp_path}/{checkpoint}", form=form,
        available_now=True).awaitTermination()


def sink(spark, tmp_path, schema=schemas.CLEANED_ORDERS):
    return streams.read_sink(spark, f"{tmp_path}/orders", schema)


def expected(spark, tmp_path, dims, form="union"):
    rows = clean.clean_orders(messages.read_messages(spark, str(tmp_path / "in")))
    return enrich.enrich(rows, *dims, form=form)


def same(left, right, drop=("processed_at", "writer", "batch_id")):
    left, right = left.drop(*drop), right.drop(*drop)
    return left.columns == right.columns and sorted(map(str, left.collect())) == sorted(
        map(str, right.collect()))


@pytest.mark.parametrize("max_files", [None, 1])
def test_cleaning_equals_batch(spark, tmp_path, dims, max_files):
    for f in range(3):
        put(tmp_path, f"{f}.json", *(body(i) for i in range(f * 10, f * 10 + 10)), "broken")
    clean_run(spark, tmp_path, dims, max_files)
    result = sink(spark, tmp_path)
    assert same(result, expected(spark, tmp_path, dims))
    assert result.select("batch_id").distinct().count() == (3 if max_files else 1)
    rejects = spark.read.parquet(f"{tmp_path}/rejects")
    assert [(r.value, r.reason) for r in rejects.collect()] == 3 * [("broken", "bad_json")]


def test_restart_goes_on_where_it_stopped(spark, tmp_path, dims):
    put(tmp_path, "1.json", body(1), body(2))
    clean_run(spark, tmp_path, dims)
    put(tmp_path, "2.json", body(3))
    clean_run(spark, tmp_path, dims)
    clean_run(spark, tmp_path, dims)  # nothing new
    assert same(sink(spark, tmp_path), expected(spark, tmp_path, dims))


def test_another_query_appends_to_the_same_table(spark, tmp_path, dims):
    put(tmp_path, "1.json", body(1))
    clean_run(spark, tmp_path, dims)
    clean_run(spark, tmp_path, dims, checkpoint="other")
    assert sink(spark, tmp_path).count() == 2 * expected(spark, tmp_path, dims).count() > 0


def test_repeated_batch_is_stored_once(spark, tmp_path, dims):
    """A batch whose commit got lost is run again on restart."""
    put(tmp_path, "1.json", body(1), body(2), body(3))
    clean_run(spark, tmp_path, dims)
    before = sorted(map(str, sink(spark, tmp_path).drop("processed_at").collect()))
    for file in (tmp_path / "check" / "commits").glob("*0*"):
        file.unlink()
    clean_run(spark, tmp_path, dims)
    assert sorted(map(str, sink(spark, tmp_path).drop("processed_at").collect())) == before


def test_joined_form(spark, tmp_path, dims):
    put(tmp_path, "1.json", *(body(i) for i in range(6)))
    clean_run(spark, tmp_path, dims, form="joined")
    assert same(sink(spark, tmp_path, schemas.ENRICHED_ORDERS),
                expected(spark, tmp_path, dims, "joined"))


def enriched_stream(spark, tmp_path, dims, form="joined"):
    """Messages to the enriched table, and that table as a stream, one file at a time."""
    clean_run(spark, tmp_path, dims, 1, form=form)
    schema = enrich.FORMS[form][1]
    return streams.stream_sink(spark, f"{tmp_path}/orders", schema, max_files=1)


@pytest.mark.parametrize("form", ["joined", "union"])
def test_metrics_equal_batch_after_every_version(spark, tmp_path, dims, form):
    for f in range(3):
        put(tmp_path, f"{f}.json", *(body(i) for i in range(f * 10, f * 10 + 10)))
    streams.start_metrics(
        enriched_stream(spark, tmp_path, dims, form), metrics_path=f"{tmp_path}/metrics",
        checkpoint=f"{tmp_path}/totals", available_now=True).awaitTermination()
    versions = streams.read_sink(spark, f"{tmp_path}/metrics", schemas.CLIENT_METRICS)
    assert versions.count() >= 3 * 2
    latest = metrics.latest_metrics(versions).drop("load_timestamp")
    batch = enrich.FORMS[form][0](
        clean.clean_orders(messages.read_messages(spark, str(tmp_path / "in"))), *dims)
    assert same(latest, metrics.client_metrics(batch))


def windows_run(spark, tmp_path, dims):
    query = streams.start_windowed_metrics(
        enriched_stream(spark, tmp_path, dims), metrics_path=f"{tmp_path}/windows",
        checkpoint=f"{tmp_path}/spans", available_now=True)
    query.awaitTermination()
    rows = streams.read_sink(spark, f"{tmp_path}/windows", schemas.WINDOWED_METRICS).collect()
    return streams.late_rows(query), sorted(
        (str(r.window_start)[11:16], r.client_id, r.order_count, r.total_revenue) for r in rows)


def at(i: int, time: str, day: str = "2024-05-01") -> str:
    return body(i, order_date=f"{day} {time}")


def test_windows_close_with_the_watermark(spark, tmp_path, dims):
    put(tmp_path, "1.json", at(0, "10:00:10"), at(3, "10:00:50"), at(1, "10:01:00"),
        at(1, "10:11:30"), at(2, "10:11:30"))  # the client of order 2 is unknown
    # Latest 10:11:30 less ten minutes: the window from 10:00 is closed, that from 10:01 is not.
    assert windows_run(spark, tmp_path, dims) == (0, [("10:00", "c0", 2, 3.5)])
    put(tmp_path, "2.json", at(6, "10:00:30"), at(4, "10:01:45"), at(3, "10:30:00"))
    # 10:00:30 comes too late, which is told; 10:01:45 still counts; 10:30 closes all before 10:20.
    late, rows = windows_run(spark, tmp_path, dims)
    assert late > 0 and rows == [
        ("10:00", "c0", 2, 3.5), ("10:01", "c1", 2, 5.5), ("10:11", "c1", 1, 1.25)]


def test_windows_over_years_lose_nothing_in_many_batches(spark, tmp_path, dims):
    for f in range(5):
        put(tmp_path, f"{f}.json", *(at(i, f"10:{i % 60:02d}:00", f"{2019 + f}-0{1 + i % 9}-01") for i in range(20)))
    late, rows = windows_run(spark, tmp_path, dims)
    known = sum(20 - len([i for i in range(20) if i % 3 == 2]) for _ in range(5))
    assert late == 0 and known - 2 <= sum(r[2] for r in rows) <= known


def test_orders_without_a_date_are_told(spark, tmp_path, dims):
    put(tmp_path, "1.json", body(1), body(3, order_date=None), body(4, order_date="soon"))
    orders = enrich.joined_form(clean.clean_orders(messages.read_messages(spark, str(tmp_path / "in"))), *dims)
    assert sorted((r.order_id, r.reason) for r in metrics.undated(orders).collect()) == [
        ("o3", "no_date"), ("o4", "no_date")]
    assert sum(r.order_count for r in metrics.client_metrics_windowed(orders).collect()) == 1


@pytest.mark.parametrize("max_files", [None, 1])
def test_repeated_messages_can_be_dropped(spark, tmp_path, max_files):
    """Dates that span years and come in no order: none is too late."""
    for f, year in enumerate((2024, 1999, 2010)):
        put(tmp_path, f"{f}.json", *(at(i, "10:00:00", f"{year}-01-01") for i in range(f, f + 4)), body(1))
    rows = clean.clean_orders(stream(spark, tmp_path, max_files))
    once = quality.dedup_stream(rows, ["order_id"])
    streams.start_appending(once, path=f"{tmp_path}/once", checkpoint=f"{tmp_path}/check",
                            available_now=True).awaitTermination()
    found = streams.read_sink(spark, f"{tmp_path}/once", once.schema).collect()
    assert sorted(r.order_id for r in found) == [f"o{i}" for i in range(6)]


def test_windows_of_years_that_are_many_files(spark):
    """Splits so small that every year is read, and so written, in several tasks."""
    from tillwise.plans import queries

    small = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1"}
    whole = sorted(map(str, queries.client_metrics_windowed(spark, "/root/testdata/sf0.001").collect()))
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        got = queries.stream_windowed_metrics(spark, "/root/testdata/sf0.001").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # The last windows stay open.
    assert len(got) > 0.9 * len(whole) and set(map(str, got)) <= set(whole)


@pytest.fixture
def many_files(spark):
    """Shuffles that keep all their partitions, so that tables come in many files."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_batches_do_not_grow_with_the_files(many_files, monkeypatch, tmp_path):
    from tillwise.plans import queries

    monkeypatch.setattr(scratch, "new_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    folder = "/root/testdata/sf0.001"
    got = queries.stream_client_metrics(many_files, folder)
    base = f"{tmp_path}/metrics"
    assert len(messages.read_messages(many_files, f"{base}/messages").inputFiles()) > queries.BATCHES
    for name, schema in (("orders", schemas.ENRICHED_ORDERS), ("metrics", schemas.CLIENT_METRICS)):
        rows = streams.read_sink(many_files, f"{base}/{name}", schema)
        assert 1 < rows.select("batch_id").distinct().count() <= queries.BATCHES
    monkeypatch.undo()
    assert same(got, queries.client_metrics(many_files, folder))


def test_messages_by_year_are_made_once_and_read_by_year(spark):
    from tillwise.sources import star_schema

    folder = "/root/testdata/sf0.001"
    parts = list(star_schema.messages_by_year(spark, folder))
    assert sorted(r.value for part in parts for r in part.collect()) == sorted(
        r.value for r in star_schema.order_messages(spark, folder).collect())
    for part in parts:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "to_json" not in plan and "PartitionFilters: [is" in plan


def test_packed_dimensions_are_not_taken_for_small_ones(spark):
    """A file of some megabytes holds more rows than a broadcast is to send."""
    many = spark.range(1_500_000).select(F.col("id").cast("string").alias("client_id"), F.lit("same name").alias("name"))
    clients = scratch.stored(spark, many.repartition(1), "packed")
    assert sum(os.path.getsize(f.removeprefix("file://")) for f in clients.inputFiles()) < 10 << 20
    joined = spark.range(9_000_000).select(F.col("id").cast("string").alias("client_id")).join(clients, "client_id")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
