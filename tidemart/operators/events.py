"""From wire records to fact rows. Works on batches and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import event_time
from tidemart.operators.lookup import BROADCAST_BYTES, lookup
from tidemart.schemas import EVENT_PAYLOAD, RAW_PAYLOAD, UNKNOWN_CATEGORY, USER_EVENTS


def parse_json(wire: DataFrame, payload: T.StructType) -> DataFrame:
    """One row per record; what cannot be read as its declared type becomes NULL.

    The fields come out of a generator, below which no filter can be moved. Otherwise a
    filter on a field would have the JSON of every record read twice.
    """
    event = F.from_json(F.col("value").cast("string"), payload)
    return wire.select(F.inline(F.array(event)))


def parse_events(wire: DataFrame) -> DataFrame:
    """Events with a user id. Malformed records have none and are left out."""
    return parse_json(wire, EVENT_PAYLOAD).filter(F.col("user_id").isNotNull())


def parse_raw_events(wire: DataFrame) -> DataFrame:
    """All records; malformed ones become rows of NULLs."""
    return parse_json(wire, RAW_PAYLOAD)


def known_category(category: Column) -> Column:
    return F.coalesce(category, F.lit(UNKNOWN_CATEGORY))


def catalog_names(products: DataFrame) -> DataFrame:
    """The two columns of the catalog that facts are looked up by and labelled with."""
    return products.select(F.col("name").alias("product"), "category")


def add_event_time(events: DataFrame) -> DataFrame:
    """Add `event_time`, `dt` and `hr`, all NULL where `ts` does not follow the pattern."""
    timed = events.withColumn("event_time", event_time.parse(F.col("ts")))
    return timed.withColumn("dt", event_time.day(F.col("event_time"))).withColumn(
        "hr", event_time.hour(F.col("event_time"))
    )


def enrich(
    events: DataFrame,
    products: DataFrame,
    broadcast_limit: int | None = BROADCAST_BYTES,
    salts: int = 1,
) -> DataFrame:
    """Fact rows: events with the category of their product and with their day and hour."""
    labelled = lookup(
        events, catalog_names(products), "product", broadcast_limit=broadcast_limit, salts=salts
    )
    labelled = labelled.withColumn("category", known_category(F.col("category")))
    return add_event_time(labelled).select(*USER_EVENTS.fieldNames())
