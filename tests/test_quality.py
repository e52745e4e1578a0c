import pytest
from rows import by, client, item, order, product, table, ts

from tillwise.operators import quality


def test_null_profile(spark):
    df = table(spark, "products", product("p"), product("q", category=None), product(None))
    rows = by(quality.null_profile(df, "products"), "column_name")
    assert rows.keys() == {"product_name", "category", "unit_price", "stock"}
    assert rows["category"] == {"table_name": "products", "column_name": "category", "n_rows": 3,
                                "n_nulls": 1, "null_rate": 0.3333}
    assert rows["stock"]["n_nulls"] == 0


def test_null_profile_of_an_empty_table(spark):
    rows = by(quality.null_profile(table(spark, "products"), "products"), "column_name")
    assert (rows["stock"]["n_rows"], rows["stock"]["null_rate"]) == (0, None)


def test_duplicates(spark):
    df = table(spark, "products", product("p"), product("p"), product("p"), product("q"),
               product("q", stock=None), product(None), product(None))
    assert {k: r["copies"] for k, r in by(quality.duplicate_rows(df), "product_id").items()} == {
        "p": 3, None: 2}
    assert {k: r["copies"] for k, r in
            by(quality.duplicate_rows(df, ["product_id"]), "product_id").items()} == {
        "p": 3, "q": 2, None: 2}
    assert quality.dedup_rows(df).count() == 4


@pytest.mark.parametrize("email, repaired", [
    ("annatshop.example", "ann@shop.example"), ("patatshop.example", None), ("nobody", None),
    ("at.example", None)])
def test_emails(spark, email, repaired):
    df = table(spark, "clients", client("a", email=email), client("b"), client("c", email=None))
    [row] = quality.email_check(df).collect()
    assert (row.client_id, row.repaired_email) == ("a", repaired)


def test_ages(spark):
    ages = [9.0, 10.0, 100.0, 101.0, None]
    df = table(spark, "clients", *(client(str(i), age=a) for i, a in enumerate(ages)))
    assert sorted(r.age for r in quality.age_check(df).collect()) == [9.0, 101.0]
    assert [r["age"] for _, r in sorted(by(quality.mend_ages(df), "client_id").items())] == [
        None, 10.0, 100.0, None, None]


def test_orphans(spark):
    orders = table(spark, "orders", order("1", "a", 1.0), order("2", "x", 1.0),
                   order("3", "x", 1.0), order("4", None, 1.0))
    clients = table(spark, "clients", client("a"), client("a"))
    relation = {"orders.client_id": (orders, clients, "client_id"),
                "clients.client_id": (clients, orders, "client_id")}
    rows = by(quality.ref_integrity(relation), "relation")
    assert (rows["orders.client_id"]["orphan_keys"], rows["orders.client_id"]["orphan_rows"]) == (1, 2)
    assert (rows["clients.client_id"]["orphan_keys"], rows["clients.client_id"]["orphan_rows"]) == (0, 0)


def test_order_totals(spark):
    orders = table(spark, "orders", order("1", "a", 20.01), order("1", "a", 20.01),
                   order("2", "a", 5.0), order("3", "a", 1.0), order("4", "a", None))
    items = table(spark, "order_items", item("1", "p", 2, 10.0), item("2", "p", 1, 4.0),
                  item("2", "q", 1, 1.0), item("4", "p", 1, 1.0))
    found = sorted(tuple(r) for r in quality.order_total_check(orders, items).collect())
    assert found == [("1", 20.01, 20.0, 0.01, 2, True), ("3", 1.0, 0.0, 1.0, 1, False)]


@pytest.mark.parametrize("rows, size", [(0, 0), (1, 1), (7, 1), (250, 25)])
def test_sample_has_its_exact_size_in_any_layout(spark, rows, size):
    df = spark.range(rows).selectExpr("cast(id % 40 as string) as k", "id % 3 as v")
    draws = [sorted(map(tuple, quality.seeded_sample(d, ["k"], 0.1, seed).collect()))
             for d, seed in ((df, 1), (df.repartition(7, "v"), 1), (df, 2))]
    assert draws[0] == draws[1] and len(draws[0]) == len(draws[2]) == size
    assert rows < 250 or draws[0] != draws[2]


def test_dates_before_registration(spark):
    clients = table(spark, "clients", client("a", registration_date=ts("2024-01-05")),
                    client("a", registration_date=ts("2024-01-03")),
                    client("b", registration_date=None))
    orders = table(spark, "orders", order("1", "a", 1.0, order_date=ts("2024-01-02")),
                   order("2", "a", 1.0, order_date=ts("2024-01-03")), order("3", "b", 1.0))
    rows = quality.date_order_check(orders, clients, "order_id", "order_date").collect()
    assert [r.order_id for r in rows] == ["1"]


def test_incidents_before_registration(spark):
    incidents = table(spark, "incidents",
                      {"incident_id": "1", "client_id": "a", "report_date": ts("2021-12-31")},
                      {"incident_id": "2", "client_id": "a", "report_date": ts("2022-01-01")},
                      {"incident_id": "3", "client_id": "z", "report_date": ts("2000-01-01")})
    rows = quality.date_order_check(incidents, table(spark, "clients", client("a")),
                                    "incident_id", "report_date").collect()
    assert [r.incident_id for r in rows] == ["1"]


def test_segments(spark):
    clients = table(spark, "clients", client("a", registration_date=ts("2023-12-02")),
                    client("b", registration_date=ts("2023-12-01 23:59:59")),
                    client("c", registration_date=None))
    rows = by(quality.segment_rule(clients, "2024-06-01"), "client_id")
    assert {k: r["expected_segment"] for k, r in rows.items()} == {
        "a": "new", "b": "regular", "c": "regular"}


def test_regions(spark):
    orders = table(spark, "orders", order("1", "a", 1.0), order("2", "a", 1.0, region="Other"),
                   order("3", "z", 1.0))
    rows = by(quality.region_check(orders, table(spark, "clients", client("a"), client("a"))),
              "country", "region")
    assert {k: (r["expected_region"], r["nb_orders"]) for k, r in rows.items()} == {
        ("France", "Europe-West"): ("Europe-West", 1), ("France", "Other"): ("Europe-West", 1),
        (None, "Europe-West"): ("Other", 1)}


def test_resolution_times(spark):
    cases = [("In progress", "Low", 1.0), ("In progress", "Critical", None),
             ("Resolved", "Critical", 25.0), ("Resolved", "Critical", 24.0),
             ("Closed", "Low", 168.0), ("Closed", None, 169.0), (None, "Low", 200.0)]
    df = table(spark, "incidents", *({"incident_id": str(i), "status": s, "priority": p,
                                      "resolution_time_h": h} for i, (s, p, h) in enumerate(cases)))
    rows = by(quality.resolution_rule(df), "incident_id")
    assert {k: r["violation"] for k, r in rows.items()} == {
        "0": "time_while_open", "2": "over_limit", "5": "over_limit", "6": "over_limit"}


def test_bands(spark):
    products = table(spark, "products", product("p", price=100.0), product("q", "Audio", 10.0),
                     product("r", "Unknown", 1.0))
    items = table(spark, "order_items", item("1", "p", 1, 105.0), item("2", "p", 1, 105.01),
                  item("3", "p", 1, 94.99), item("4", "p", 1, None), item("5", "zz", 1, 1.0))
    assert sorted(r.item_id for r in quality.price_band_check(items, products).collect()) == [
        "2-p", "3-p"]
    assert [r.product_id for r in quality.catalogue_band_check(products).collect()] == ["q"]
    visits = table(spark, "page_views",
                   {"session_id": "1", "page": "/home", "duration_seconds": 61.0},
                   {"session_id": "2", "page": "/home", "duration_seconds": 60.0},
                   {"session_id": "3", "page": "/new", "duration_seconds": 1.0})
    assert [r.session_id for r in quality.duration_band_check(visits).collect()] == ["1"]


def test_accepted_values(spark):
    df = table(spark, "products", product("p"), product("q", "Toys"), product("r", "Toys"),
               product("s", None))
    assert [tuple(r) for r in quality.accepted_values(df, "products").collect()] == [
        ("products", "category", "Toys", 2)]
