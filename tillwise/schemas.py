"""Column names and types of the six shop tables and the two sinks. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DecimalType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {"string": StringType(), "double": DoubleType(), "bigint": LongType(),
          "timestamp": TimestampType(), "units": DecimalType(38, 0)}


def _schema(columns: str) -> StructType:
    fields = (entry.split() for entry in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


# The names and types of the data model.
CLIENTS = _schema(
    "client_id string, last_name string, first_name string, email string, age double, gender "
    "string, country string, city string, phone string, registration_date timestamp, segment "
    "string")
PRODUCTS = _schema(
    "product_id string, product_name string, category string, unit_price double, stock bigint")
ORDERS = _schema(
    "order_id string, client_id string, order_date timestamp, status string, payment_method "
    "string, region string, total_amount double")
ORDER_ITEMS = _schema(
    "item_id string, order_id string, product_id string, quantity double, unit_price double")
INCIDENTS = _schema(
    "incident_id string, client_id string, report_date timestamp, category string, order_id "
    "string, status string, priority string, resolution_time_h double")
PAGE_VIEWS = _schema(
    "session_id string, client_id string, page string, event_datetime timestamp, duration_seconds "
    "double, device string, browser string, traffic_source string")

TABLES = {
    "clients": CLIENTS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "incidents": INCIDENTS,
    "page_views": PAGE_VIEWS,
}

CLEANED_ORDERS = _schema(
    "order_id string, client_id string, product_id string, total_amount double, status string, "
    "order_date timestamp, sent_at timestamp, processed_at timestamp, name string, email string, "
    "category string")
ENRICHED_ORDERS = StructType(CLEANED_ORDERS.fields + [StructField("product_name", StringType())])
CLIENT_METRICS = _schema(
    "client_id string, order_count bigint, total_revenue double, load_timestamp timestamp")

WINDOWED_METRICS = _schema(
    "window_start timestamp, window_end timestamp, client_id string, order_count bigint, "
    "total_revenue double")
# Totals that can be added up (functions.numbers.unit_parts).
CLIENT_TOTALS = _schema("client_id string, order_count bigint, units units, rest double, amounts bigint")
WINDOW_TOTALS = _schema(
    "window_start timestamp, window_end timestamp, client_id string, order_count bigint, units units, "
    "rest double, amounts bigint")
MESSAGES = _schema("value string")
REJECTS = _schema("value string, reason string")


def with_columns(schema: StructType, **types: str) -> StructType:
    """The schema with more columns at its end."""
    wider = StructType(list(schema.fields))
    for name, data_type in types.items():
        wider.add(name, data_type)
    return wider


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the declared types in the declared order; a column the input lacks is NULL."""
    return df.select(*(
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields))
