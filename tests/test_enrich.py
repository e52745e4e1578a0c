import pytest
from rows import by, client, product, table, ts

from tillwise import schemas, scratch
from tillwise.operators import dimensions, enrich, metrics


@pytest.fixture
def orders(spark):
    rows = [("1", "a", "p", 10.0, "2024-01-01 10:00:05"), ("2", "a", "x", 5.0, "2024-01-01 10:00:59"),
            ("3", "z", "p", 2.5, "2024-01-01 10:01:00"), ("4", "b", "q", 1.0, None),
            ("5", "z", "x", 9.0, "2024-01-01 10:01:00")]
    return spark.createDataFrame(
        [(o, c, p, x, ts(t) if t else None) for o, c, p, x, t in rows],
        "order_id string, client_id string, product_id string, total_amount double, "
        "order_date timestamp")


@pytest.fixture
def dims(spark):
    clients = table(spark, "clients", client("a", last_name="B"), client("a", last_name="A"),
                    client("b", first_name=None, email=None))
    products = table(spark, "products", product("p"), product("q"))
    return dimensions.client_dimension(clients), dimensions.product_dimension(products)


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "a"), ("k", 1, "z"), ("k", 1, "b"), ("n", 5, "a"),
                                ("n", None, "q"), (None, 1, "x")], "key string, a int, b string")
    rows = by(dimensions.first_per_key(df, "key"), "key")
    assert {k: (r["a"], r["b"]) for k, r in rows.items()} == {
        "k": (1, "b"), "n": (None, "q"), None: (1, "x")}


def test_joins_drop_what_is_unknown(orders, dims):
    clients, products = dims
    assert {r.order_id: r.name for r in enrich.with_clients(orders, clients).collect()} == {
        "1": "Ann A", "2": "Ann A", "4": "b"}
    assert {r.order_id: r.category for r in enrich.with_products(orders, products).collect()} == {
        "1": "Audio", "3": "Audio", "4": "Audio"}


def test_union_holds_an_order_once_per_match(orders, dims):
    rows = enrich.enrich(orders, *dims, form="union")
    assert rows.schema == schemas.CLEANED_ORDERS
    assert sorted(r.order_id for r in rows.collect()) == ["1", "1", "2", "3", "4", "4"]
    names = {(r.order_id, r.name, r.email, r.category) for r in rows.collect()}
    assert ("1", "Ann A", "a@shop.example", None) in names
    assert ("1", "name p", None, "Audio") in names


def test_joined_holds_both_names(orders, dims):
    rows = by(enrich.enrich(orders, *dims, form="joined"), "order_id")
    assert rows.keys() == {"1", "4"}
    assert (rows["1"]["name"], rows["1"]["product_name"]) == ("Ann A", "name p")


def test_union_metrics_are_twice_the_joined_ones_when_all_match(spark, orders, dims):
    known = orders.filter("order_id in ('1', '4')")
    union = by(metrics.client_metrics(enrich.union_form(known, *dims)), "client_id")
    joined = by(metrics.client_metrics(enrich.joined_form(known, *dims)), "client_id")
    assert union == {k: {"client_id": k, "order_count": 2 * r["order_count"],
                         "total_revenue": 2 * r["total_revenue"]} for k, r in joined.items()}


def test_windows(orders):
    rows = by(metrics.client_metrics_windowed(orders), "window_start", "client_id")
    assert {k: (r["order_count"], r["total_revenue"]) for k, r in rows.items()} == {
        (ts("2024-01-01 10:00:00"), "a"): (2, 15.0), (ts("2024-01-01 10:01:00"), "z"): (2, 11.5)}


def test_stored_dimension_is_a_plain_scan(spark, dims):
    clients, _ = dims
    stored = scratch.stored(spark, clients, "clients")
    assert sorted(stored.collect()) == sorted(clients.collect())
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()
