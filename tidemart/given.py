"""The given tables in the shapes of the event model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import event_time

# The event types of the given data that count as healthy; `error` is left out.
HEALTHY_TYPES = ("signup", "purchase", "view", "click")


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows without a category: the product is the key inside `props`."""
    events = given(spark, sf_dir, "events")
    return events.select(
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").alias("product"),
        F.col("value").alias("amount"),
        event_time.wire_text(F.col("ts")).alias("ts"),
        event_time.day(F.col("ts")).alias("dt"),
        event_time.hour(F.col("ts")).alias("hr"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog. Large parts are listed under a name no event uses."""
    parts = given(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return parts.select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.when(F.col("p_size") > 45, F.concat(F.lit("retired-"), key)).otherwise(key).alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("base_price"),
        ((F.col("p_size") - 5) * 10).alias("stock"),
    )


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as a broker delivers them: all events, and two kinds of bad records.

    Customers give signups whose user id is text, documents give records that are no JSON.
    """
    good = user_events(spark, sf_dir).select(
        F.to_json(F.struct("user_id", "event_type", "product", "amount", "ts")).alias("value")
    )
    text_ids = given(spark, sf_dir, "customer").select(
        F.to_json(
            F.struct(F.col("c_name").alias("user_id"), F.lit("signup").alias("event_type"))
        ).alias("value")
    )
    no_json = given(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    wire = good.unionByName(text_ids).unionByName(no_json)
    return wire.select(F.col("value").cast("binary").alias("value"))


def wire_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: purchases carry fractional amounts, other events whole ones."""
    events = given(spark, sf_dir, "events")
    user, event = F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("event")
    ts = event_time.wire_text(F.col("ts")).alias("ts")
    exact = F.struct(user, event, F.col("value").alias("amount"), ts)
    whole = F.struct(user, event, F.round("value").cast("int").alias("amount"), ts)
    is_purchase = F.col("event_type") == "purchase"
    good = events.select(
        F.when(is_purchase, F.to_json(exact)).otherwise(F.to_json(whole)).alias("value")
    )
    no_json = given(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return good.unionByName(no_json).select(F.col("value").cast("binary").alias("value"))


def message_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter samples: a message counter per topic that restarts every thousand messages."""
    events = given(spark, sf_dir, "events")
    return events.select(
        F.lit("messages_total").alias("metric"),
        F.create_map(F.lit("topic"), F.col("event_type"), F.lit("job"), F.lit("broker")).alias("labels"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.pmod(F.col("event_id"), F.lit(1000)).cast("double").alias("value"),
    )


def consumer_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge samples: a lag per consumer group, topic and client, with the order as tie-break."""
    orders = given(spark, sf_dir, "orders")
    return orders.select(
        F.lit("consumergroup_lag").alias("metric"),
        F.create_map(
            F.lit("consumergroup"), F.col("o_orderstatus"),
            F.lit("topic"), F.col("o_orderpriority"),
            F.lit("client"), F.col("o_custkey").cast("string"),
            F.lit("sequence"), F.col("o_orderkey").cast("string"),
        ).alias("labels"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("value"),
    )
