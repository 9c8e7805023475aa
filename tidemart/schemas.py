"""Table schemas and value domains, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemart.functions.money import AMOUNT_RESIDUE, MEASURES


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_long, _int, _double, _bool = T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_text, _time = T.StringType(), T.TimestampType()

# Wire payloads.
EVENT_PAYLOAD = _schema(
    ("user_id", _long), ("event_type", _text), ("product", _text), ("amount", _double), ("ts", _text)
)
RAW_PAYLOAD = _schema(("user_id", _text), ("event", _text), ("amount", _int), ("ts", _text))

# Fact tables.
USER_EVENTS = _schema(
    ("user_id", _long), ("event_type", _text), ("product", _text), ("category", _text),
    ("amount", _double), ("ts", _text), ("event_time", _time), ("dt", _text), ("hr", _text),
)
USER_EVENTS_PARTITIONS = ("dt", "hr")
RAW_EVENTS = RAW_PAYLOAD

# Daily marts, partitioned by day.
REVENUE_BY_CATEGORY = _schema(
    ("dt", _text), ("category", _text), ("event_type", _text),
    ("event_count", _long), ("total_revenue", _double), ("avg_order", _double),
)
TOP_PRODUCTS = _schema(
    ("dt", _text), ("product", _text), ("category", _text), ("orders", _long), ("revenue", _double)
)
HOURLY_COUNTS = _schema(("dt", _text), ("hr", _text), ("event_type", _text), ("event_count", _long))
DAILY_REVENUE = _schema(
    ("dt", _text), ("category", _text), ("event_type", _text),
    ("event_count", _long), ("total_revenue", _double),
)
MART_PARTITIONS = ("dt",)

# Measures of the marts by hour, event type and product, kept for each micro-batch.
EVENT_MEASURES = _schema(
    ("event_type", _text), ("product", _text), *[(name, _long) for name in MEASURES if name != AMOUNT_RESIDUE],
    (AMOUNT_RESIDUE, _double), ("dt", _text), ("hr", _text),
)

# Dimensions.
PRODUCTS = _schema(
    ("product_id", _int), ("name", _text), ("category", _text), ("base_price", T.DecimalType(10, 2)),
    ("stock", _int), ("active", _bool), ("created_at", _time),
)
CUSTOMERS = _schema(
    ("user_id", _int), ("email", _text), ("tier", _text), ("country", _text), ("joined_at", _time)
)

# Quality log.
QUALITY_METRICS = _schema(
    ("run_date", _text), ("check_name", _text), ("status", _text),
    ("value", _text), ("threshold", _text), ("created_at", _time),
)

# Counts of the quality checks, kept by day.
QUALITY_STATES = _schema(
    ("total", _long), ("null_users", _long), ("null_types", _long), ("purchases", _long),
    ("bad_amounts", _long), ("invalid_types", _long), ("dt", _text),
)

# Metric samples.
METRIC_SAMPLES = _schema(
    ("metric", _text), ("labels", T.MapType(_text, _text)), ("ts", _time), ("value", _double)
)

# The event types a healthy stream carries, and the type that means a sale.
EVENT_TYPES = ("purchase", "view", "add_to_cart", "remove_from_cart", "wishlist")
PURCHASE = "purchase"

# The category of products missing from the catalog.
UNKNOWN_CATEGORY = "unknown"
