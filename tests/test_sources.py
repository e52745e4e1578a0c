import json
from datetime import date

import pytest
from rows import by, client, order, product, table, ts
from pyspark.sql import functions as F

from tillwise import schemas, scratch
from tillwise.sources import csv_files, landing, messages, tables


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def lines(path, *rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def test_csv_keeps_breaks_quotes_and_nulls(spark, folder):
    clients = table(spark, "clients", client("a", city='Aix\n"les" Bains, F'), client("b", city=""),
                    client("c", city=None, age=None), client("d", age=41.5))
    csv_files.write_csv(clients, f"{folder}/c")
    back = csv_files.load_csv(spark, schemas.CLIENTS, f"{folder}/c")
    assert back.schema == schemas.CLIENTS
    assert sorted(back.collect(), key=lambda r: r.client_id) == clients.collect()


def test_csv_with_header_only(spark, tmp_path):
    path = lines(tmp_path / "p.csv", "product_id,product_name,category,unit_price,stock")
    assert csv_files.load_csv(spark, schemas.PRODUCTS, path).count() == 0


def test_csv_load_fails_on_a_bad_row(spark, tmp_path):
    path = lines(tmp_path / "p.csv", "product_id,product_name,category,unit_price,stock",
                 "p,n,c,cheap,1")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.load_csv(spark, schemas.PRODUCTS, path).collect()


def test_csv_load_with_rejects(spark, tmp_path):
    path = lines(tmp_path / "p.csv", "product_id,product_name,category,unit_price,stock",
                 "p,n,c,1.5,1", "q,n,c,cheap,1", "r,n", 's,"two\nlines",,,', "t,n,c,1,2,3")
    good, bad = csv_files.load_csv_with_rejects(spark, schemas.PRODUCTS, path)
    assert [tuple(r) for r in good.collect()] == [("p", "n", "c", 1.5, 1),
                                                  ("s", "two\nlines", None, None, None)]
    assert good.select("product_id").count() == 2  # whichever columns are used
    assert {tuple(r) for r in bad.collect()} == {
        ("q,n,c,cheap,1", "bad_value"), ("r,n", "bad_width"), ("t,n,c,1,2,3", "bad_width")}


def test_csv_by_position(spark, tmp_path):
    path = lines(tmp_path / "c.csv", "client_id,last_name,first_name,email",
                 "a,Doe,Ann,a@x", "b,Roe", "c,Poe,Cy", "d,Moe,Di,d@x,more", 'e,"O""k",Ed,')
    rows, rejects = csv_files.load_by_position(spark, path, ["client_id", "name", "email"], 4)
    assert [tuple(r) for r in rows.collect()] == [
        ("a", "Doe", "Ann"), ("c", "Poe", "Cy"), ("d", "Moe", "Di"), ("e", 'O"k', "Ed")]
    assert [tuple(r) for r in rejects.collect()] == [("b,Roe", "short_row")]


def test_events_as_json(spark):
    orders = table(spark, "orders", order("1", "a", 10.5), order("2", "b", None, status=None))
    rows = by(messages.encode_events(orders, sent_at="2024-05-01 10:00:00"), "key")
    assert json.loads(rows["1"]["value"]) == {
        "order_id": "1", "client_id": "a", "total_amount": 10.5, "status": "Delivered",
        "order_date": "2024-01-10 00:00:00", "sent_at": "2024-05-01T10:00:00.000000"}
    assert json.loads(rows["2"]["value"])["total_amount"] is None
    with_product = messages.encode_events(orders.withColumn("product_id", F.lit("p")))
    assert json.loads(with_product.first().value)["product_id"] == "p"
    assert messages.encode_events(orders, limit=1).count() == 1


def test_messages_as_files(spark, folder):
    orders = table(spark, "orders", order("1", "a\nb", 10.5), order("2", "b", 1.0))
    sent = messages.encode_events(orders, sent_at="2024-05-01 10:00:00")
    messages.write_messages(sent, folder)
    messages.write_messages(sent, folder)
    back = [r.value for r in messages.read_messages(spark, folder).collect()]
    assert sorted(back) == sorted(2 * [r.value for r in sent.collect()])


@pytest.fixture
def orders_by_day(spark, folder):
    days = [f"2024-01-{d:02d}" for d in (1, 2, 3, 31)]
    orders = table(spark, "orders", *(
        order(f"{d}-{i}", f"c{i % 3}", 1.0 * i, order_date=ts(d), region="EW"[i % 2])
        for d in days for i in range(40)))
    tables.write_table(orders, "orders", f"{folder}/orders")
    return orders, tables.read_table(spark, "orders", f"{folder}/orders")


def test_table_by_day(orders_by_day):
    orders, back = orders_by_day
    assert sorted(back.drop("day").collect()) == sorted(orders.collect())
    assert {r.day for r in back.select("day").distinct().collect()} == {
        date(2024, 1, d) for d in (1, 2, 3, 31)}


def test_only_the_days_asked_for_are_read(orders_by_day):
    _, back = orders_by_day
    two = tables.between_days(back, "orders", date(2024, 1, 2), date(2024, 1, 3))
    assert two.count() == 80
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_rows_are_clustered_in_files(spark, orders_by_day):
    _, back = orders_by_day
    for file in back.inputFiles():
        keys = [(r.client_id, r.region) for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_a_day_without_order_date_is_kept(spark, folder):
    orders = table(spark, "orders", order("1", "a", 1.0, order_date=None), order("2", "a", 1.0))
    tables.write_table(orders, "orders", f"{folder}/o")
    assert tables.read_table(spark, "orders", f"{folder}/o").count() == 2


def test_catalog_tables(spark, folder):
    tables.create_tables(spark, "shop_test", f"{folder}/shop")
    try:
        orders = table(spark, "orders", order("1", "a", 1.0), order("2", "b", 2.0))
        for _ in range(2):  # loading again replaces
            tables.load_table(spark, "shop_test", "orders", orders)
        back = spark.table("shop_test.orders")
        assert back.columns == [*orders.columns, "day"]
        assert sorted(back.drop("day").collect()) == sorted(orders.collect())
        properties = {r.key: r.value for r in
                      spark.sql("SHOW TBLPROPERTIES shop_test.clients").collect()}
        assert (properties["pii"], properties["domain"]) == ("true", "customer")
        assert spark.table("shop_test.products").count() == 0
        tables.create_tables(spark, "shop_test", f"{folder}/again")
        assert spark.table("shop_test.orders").count() == 0
    finally:
        spark.sql("DROP DATABASE shop_test CASCADE")


def test_landing(spark, tmp_path):
    source, zone = tmp_path / "in", f"{tmp_path}/raw"
    landing.write_folder({"clients": table(spark, "clients", client("a"), client("b")).coalesce(1),
                          "products": table(spark, "products", product("p")).coalesce(1)}, str(source))
    lines(source / "new.csv", "x,y", "1,2", '3,"a\nb"')
    lines(source / "header_only.csv", "x,y")
    lines(source / "notes.txt", "no table")
    rows = by(landing.land_folder(spark, str(source), zone), "table_name")
    assert {k: r["n_rows"] for k, r in rows.items()} == {"clients": 2, "products": 1, "new": 2, "header_only": 0}
    assert all(r["source_bytes"] > 0 and r["source_file"].endswith(".csv") for r in rows.values())
    landed = spark.read.parquet(f"{zone}/products").drop("source_file", "source_bytes")
    assert landed.schema == schemas.PRODUCTS and landed.count() == 1
    assert [(r.x, r.y) for r in spark.read.parquet(f"{zone}/new").orderBy("x").collect()] == [("1", "2"), ("3", "a\nb")]


def test_landing_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert landing.land_folder(spark, f"{tmp_path}/in", f"{tmp_path}/raw").collect() == []


def test_scratch_follows_the_session(spark):
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")
    assert scratch.new_folder(spark, "x").startswith(scratch.shared_folder(spark))

    class Cluster:
        """A session on a cluster, with and without the setting."""

        def __init__(self, folder):
            self.folder = folder
            self.conf = self
            self.sparkContext = type("Context", (), {"master": "yarn"})

        def get(self, key, default):
            return self.folder if key == "spark.checkpoint.dir" else default

    assert scratch.new_folder(Cluster("hdfs:/shared/"), "x").startswith("hdfs:/shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.new_folder(Cluster(None), "x")
