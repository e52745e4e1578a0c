"""Small hand-made shop tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tillwise import schemas


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def table(spark: SparkSession, name: str, *rows: dict) -> DataFrame:
    schema = schemas.TABLES[name]
    return spark.createDataFrame(
        [tuple(row.get(f.name) for f in schema.fields) for row in rows], schema)


def client(client_id: str, **more) -> dict:
    return {"client_id": client_id, "first_name": "Ann", "last_name": client_id,
            "email": f"{client_id}@shop.example", "country": "France", "segment": "regular",
            "registration_date": ts("2022-01-01"), **more}


def order(order_id: str, client_id: str | None, amount: float | None, **more) -> dict:
    return {"order_id": order_id, "client_id": client_id, "total_amount": amount,
            "order_date": ts("2024-01-10"), "status": "Delivered", "region": "Europe-West",
            **more}


def item(order_id: str, product_id: str, quantity: float, price: float | None, **more) -> dict:
    return {"item_id": f"{order_id}-{product_id}", "order_id": order_id,
            "product_id": product_id, "quantity": float(quantity), "unit_price": price, **more}


def product(product_id: str, category: str = "Audio", price: float = 50.0, **more) -> dict:
    return {"product_id": product_id, "product_name": f"name {product_id}", "category": category,
            "unit_price": price, "stock": 1, **more}


def by(df: DataFrame, *keys: str) -> dict:
    """Result rows as dicts under the values of their key columns."""
    rows = [row.asDict() for row in df.collect()]
    found = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(found) == len(rows), "keys are not unique"
    return found
