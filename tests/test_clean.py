import json
import math

import pytest
from rows import by

from tillwise.operators import clean

GOOD = {"order_id": "o1", "client_id": "c1", "product_id": "p1", "total_amount": 12.5,
        "status": "Delivered", "order_date": "2024-05-01 10:00:00",
        "sent_at": "2024-05-01T10:00:01.5"}


def message(*drop: str, **change) -> str:
    return json.dumps({k: v for k, v in {**GOOD, **change}.items() if k not in drop})


def assessed(spark, *values, **options):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return clean.assess(df, **options)


def verdict(spark, value, **options):
    return assessed(spark, value, **options).collect()[0]


def test_good_message(spark):
    [row] = clean.accepted(assessed(spark, message())).collect()
    assert row.asDict() | {"processed_at": None} == {
        "order_id": "o1", "client_id": "c1", "product_id": "p1", "total_amount": 12.5,
        "status": "delivered", "processed_at": None,
        "order_date": row.order_date, "sent_at": row.sent_at}
    assert str(row.order_date) == "2024-05-01 10:00:00"
    assert str(row.sent_at) == "2024-05-01 10:00:01.500000"
    assert row.processed_at is not None


BAD = {
    "": "bad_json", "not json": "bad_json", "[1]": "bad_json", "5": "bad_json", "null": "bad_json",
    message()[:-3]: "bad_json", message() + "x": "bad_json", message() + "}": "bad_json",
    message() + message(): "bad_json", message() + "," + message(): "bad_json",
    "[" + message() + "]": "bad_json", message().replace('"', "'"): "bad_json",
    "{}": "missing_field", message("product_id"): "missing_field",
    message("status"): "missing_field", message("total_amount", order_id=None): "missing_field",
    message(order_id=None): "null_key", message(product_id=None, total_amount="x"): "null_key",
    message(total_amount=None): "bad_amount", message(total_amount="abc"): "bad_amount",
    message(total_amount=""): "bad_amount", message(total_amount=True): "bad_amount",
    message(total_amount="1.5f"): "bad_amount",
    message(total_amount=-1): "negative_amount", message(total_amount="-0.01"): "negative_amount",
    message(total_amount=-math.inf): "negative_amount",
}


@pytest.mark.parametrize("value", BAD, ids=range(len(BAD)))
def test_rejected(spark, value):
    assert verdict(spark, value).reason == BAD[value]


@pytest.mark.parametrize("amount, expected", [
    (0, 0.0), (" 12.5 ", 12.5), ("1e3", 1000.0), (7, 7.0), ("Infinity", math.inf),
    (math.inf, math.inf), (-0.0, 0.0)])
def test_amounts_accepted(spark, amount, expected):
    row = verdict(spark, message(total_amount=amount))
    assert (row.reason, row.total_amount) == (None, expected)


def test_nan_passes_unless_refused(spark):
    for amount in (math.nan, "nan"):
        row = verdict(spark, message(total_amount=amount))
        assert row.reason is None and math.isnan(row.total_amount)
        assert verdict(spark, message(total_amount=amount),
                       reject_nan=True).reason == "nan_amount"


@pytest.mark.parametrize("status, expected", [
    (" Delivered ", "delivered"), ("SHIPPED\n", "shipped"), ("Refunded", "unknown"),
    (None, "unknown"), ("", "unknown"), (5, "unknown")])
def test_status(spark, status, expected):
    row = verdict(spark, message(status=status))
    assert (row.reason, row.status) == (None, expected)


def test_ids_become_stripped_text(spark):
    row = verdict(spark, message(order_id="\t o 1\r\n", client_id=42, product_id="　p"))
    assert (row.order_id, row.client_id, row.product_id) == ("o 1", "42", "p")


def test_dates_may_be_absent_or_no_dates(spark):
    row = verdict(spark, message("sent_at", order_date="soon"))
    assert (row.reason, row.order_date, row.sent_at) == (None, None, None)


def test_last_of_repeated_fields_counts(spark):
    text = message()[:-1] + ', "status": "pending"}'
    assert verdict(spark, text).status == "pending"


def test_binary_values(spark):
    df = spark.createDataFrame([(bytearray(message().encode()),), (bytearray(b'\xff{"a":1}'),)],
                               "value binary")
    assert [r.reason for r in clean.assess(df).collect()] == [None, "bad_json"]


def test_accepted_and_rejected_make_the_input(spark):
    values = [message(), message(order_id="o2"), *BAD]
    df = assessed(spark, *values)
    assert clean.accepted(df).count() == 2
    assert by(clean.rejected(df), "value").keys() == set(BAD)


def test_nothing_is_parsed_twice_for_the_filter(spark):
    df = clean.accepted(assessed(spark, message()))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1
