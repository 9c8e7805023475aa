"""Small inputs shared by the tests."""

from __future__ import annotations

import json
from decimal import Decimal

from tidemart.schemas import EVENT_PAYLOAD

# The seed catalog as (name, category, price, stock, expected band).
CATALOG = [
    ("laptop", "electronics", "1299.99", 80, "low_stock"),
    ("phone", "electronics", "899.99", 250, "in_stock"),
    ("tablet", "electronics", "649.99", 120, "in_stock"),
    ("headphones", "audio", "199.99", 300, "in_stock"),
    ("keyboard", "peripherals", "89.99", 500, "in_stock"),
    ("monitor", "peripherals", "449.99", 60, "low_stock"),
    ("mouse", "peripherals", "49.99", 700, "in_stock"),
    ("webcam", "peripherals", "129.99", 200, "in_stock"),
    ("speaker", "audio", "249.99", 150, "in_stock"),
    ("smartwatch", "wearables", "399.99", 100, "low_stock"),
]

PRODUCT_COLUMNS = "name string, category string, base_price decimal(10,2), stock int"


def catalog(spark):
    rows = [(name, category, Decimal(price), stock) for name, category, price, stock, _ in CATALOG]
    return spark.createDataFrame(rows, PRODUCT_COLUMNS)


def wire(spark, records):
    """Wire records: objects become JSON, text and None are taken as they are."""
    values = [
        json.dumps(record).encode() if isinstance(record, dict)
        else record.encode() if isinstance(record, str)
        else record
        for record in records
    ]
    return spark.createDataFrame([(value,) for value in values], "value binary")


def event(user_id=1, event_type="view", product="laptop", amount=0.0, ts="2024-03-01T10:20:30Z"):
    return {
        "user_id": user_id, "event_type": event_type, "product": product, "amount": amount, "ts": ts
    }


def facts(spark, rows):
    """Fact rows from (user_id, event_type, product, amount, dt, hr)."""
    kinds = {field.name: field.dataType.simpleString() for field in EVENT_PAYLOAD}
    names = ["user_id", "event_type", "product", "amount"]
    schema = ", ".join(f"{name} {kinds[name]}" for name in names) + ", dt string, hr string"
    return spark.createDataFrame(rows, schema)


def exchanges(frame):
    """Number of shuffles in the plan before it runs."""
    return plan(frame).count("Exchange hashpartitioning")


def plan(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]
