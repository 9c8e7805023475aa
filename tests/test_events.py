from __future__ import annotations

import math
from datetime import datetime

import pytest
from fixtures import catalog, event, plan, wire
from pyspark.sql import functions as F

from tidemart.operators import events
from tidemart.operators.lookup import fits_broadcast, lookup, payload_bytes
from tidemart.schemas import USER_EVENTS


def parsed(spark, *records):
    return events.parse_events(wire(spark, records)).collect()


@pytest.mark.parametrize(
    "record",
    [
        "not json", "", None, '[{"user_id":1},{"user_id":2}]',
        '{"user_id":"abc","event_type":"view"}', '{"user_id":1.5}', '{"user_id":"12"}',
    ],
)
def test_records_without_a_readable_user_are_left_out(spark, record):
    assert parsed(spark, record) == []


def test_a_field_of_the_wrong_type_is_null_and_the_others_stay(spark):
    row, = parsed(spark, '{"user_id":1,"amount":"3.5","event_type":"v"}')
    assert (row["user_id"], row["amount"], row["event_type"]) == (1, None, "v")
    row, = parsed(spark, '{"user_id":1,"amount":"NaN"}')
    assert math.isnan(row["amount"])
    row, = parsed(spark, '{"user_id":1,"event_type":5}')
    assert row["event_type"] == "5"


def test_unknown_fields_and_trailing_text_are_ignored(spark):
    rows = parsed(spark, '{"user_id":1,"extra":{"a":1}}', '{"user_id":2} trailing')
    assert sorted(row["user_id"] for row in rows) == [1, 2]


def test_raw_events_keep_malformed_records(spark):
    records = ["bad", '{"user_id":"u","event":"e","amount":12.5}', '{"user_id":"w","amount":3}']
    rows = {tuple(row) for row in events.parse_raw_events(wire(spark, records)).collect()}
    assert rows == {
        (None, None, None, None), ("u", "e", None, None), ("w", None, 3, None)
    }


def enriched(spark, *records, products=None, **settings):
    parsed_events = events.parse_events(wire(spark, records))
    return events.enrich(parsed_events, catalog(spark) if products is None else products, **settings)


def test_enriched_rows_have_the_table_schema(spark):
    frame = enriched(spark, event(product="mouse"))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in USER_EVENTS]
    row = frame.first()
    assert row["category"] == "peripherals"
    assert row["event_time"] == datetime(2024, 3, 1, 10, 20, 30)
    assert (row["dt"], row["hr"]) == ("2024-03-01", "10")


@pytest.mark.parametrize("ts", ["garbage", "2024-03-01T10:20:30.123Z", "2024-03-01", None])
def test_unreadable_time_gives_nulls(spark, ts):
    row = enriched(spark, event(ts=ts)).first()
    assert (row["event_time"], row["dt"], row["hr"], row["ts"]) == (None, None, None, ts)


def test_unlisted_products_and_missing_categories_are_unknown(spark):
    products = spark.createDataFrame([("a", None), ("b", "books")], "name string, category string")
    frame = enriched(
        spark, event(1, product="a"), event(2, product="b"), event(3, product="c"),
        event(4, product=None), products=products,
    )
    assert {row["user_id"]: row["category"] for row in frame.collect()} == {
        1: "unknown", 2: "books", 3: "unknown", 4: "unknown"
    }


def test_a_name_listed_twice_doubles_its_events(spark):
    products = spark.createDataFrame([("a", "x"), ("a", "y")], "name string, category string")
    rows = enriched(spark, event(product="a"), products=products).collect()
    assert sorted(row["category"] for row in rows) == ["x", "y"]


def test_small_catalog_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(enriched(spark, event()))


def test_json_is_read_once(spark):
    parsed_events = events.parse_events(wire(spark, [event()]))
    assert plan(parsed_events).count("from_json") == 1


def hot_facts(spark):
    """A third of the rows have one product and another third none."""
    key = F.when(F.col("id") % 3 == 0, "p0").when(F.col("id") % 3 == 1, F.concat(F.lit("p"), F.col("id") % 50))
    return spark.range(0, 3000, 1, 8).select(key.alias("product"), (F.col("id") % 7).alias("v"))


def listed(spark):
    return spark.range(40).select(
        F.concat(F.lit("p"), F.col("id")).alias("product"), F.col("id").cast("string").alias("category")
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("settings", [{"broadcast_limit": 0}, {"broadcast_limit": 0, "salts": 5}])
def test_every_way_of_joining_gives_the_same_rows(spark, how, settings):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        columns = ["product", "v", "category"]
        frame = lookup(hot_facts(spark), listed(spark), "product", how, **settings)
        assert "BroadcastHashJoin" not in plan(frame)
        got = frame.select(columns).groupBy(columns).count().collect()
        broadcast = lookup(hot_facts(spark), listed(spark), "product", how)
        wanted = broadcast.select(columns).groupBy(columns).count().collect()
        assert set(got) == set(wanted) and len(got) == len(wanted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salts_spread_a_hot_key(spark):
    frame = spark.range(0, 800, 1, 8).select(F.lit("hot").alias("product"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dimension = spark.createDataFrame([("hot", "c")], "product string, category string")
        joined = lookup(frame, dimension, "product", broadcast_limit=0, salts=8)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 2 and sum(row["count"] for row in sizes) == 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_size_of_a_dimension_is_measured(spark):
    frame = spark.createDataFrame([("a" * 1000, "é"), (None, None)], "name string, category string")
    assert payload_bytes(frame) == 2 * 64 + 1000 + 2
    assert fits_broadcast(frame, 2000) and not fits_broadcast(frame, 1000)
    assert payload_bytes(frame.limit(0)) == 0


def test_adaptive_execution_splits_a_hot_product_of_a_large_catalog(spark):
    sizes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 200_000, 1, 8).selectExpr(
            "xxhash64(id) AS user_id", "'view' AS event_type", "1.0D AS amount",
            "'2024-03-01T00:00:00Z' AS ts",
            "IF(id % 3 = 0, 'hot', concat('p', id % 5000)) AS product",
        )
        products = spark.range(5000).selectExpr("concat('p', id) AS name", "'c' AS category")
        products = products.unionByName(spark.createDataFrame([("hot", "h")], products.schema))
        frame = events.enrich(rows, products, broadcast_limit=0)
        counts = frame.groupBy("category").agg(F.count("*").alias("count"), F.max("user_id"))
        assert {row["category"]: row["count"] for row in counts.collect()} == {"h": 66_667, "c": 133_333}
        text = counts._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_nested_columns_are_measured(spark):
    values = F.sequence(F.lit(0), F.lit(2000))
    frame = spark.range(1000).select(
        F.col("id").cast("string").alias("name"),
        values.alias("list"),
        F.map_from_arrays(values, values).alias("map"),
        F.struct(F.repeat(F.lit("x"), 10_000).alias("s")).alias("nested"),
    )
    assert payload_bytes(frame) > 1000 * (2001 * 8 * 3 + 10_000)
    assert not fits_broadcast(frame)


def test_large_catalogs_are_not_broadcast(spark):
    """Not even where Spark would do so by its own statistics."""
    for settings in ({}, {"salts": 4}):
        text = plan(enriched(spark, *[event(i, product="mouse") for i in range(20)], broadcast_limit=0, **settings))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_only_hot_keys_are_salted(spark):
    from tidemart.operators.lookup import hot_keys

    frame = spark.range(0, 900, 1, 8).select(
        F.when(F.col("id") < 300, "hot").when(F.col("id") < 310, None).otherwise(F.concat(F.lit("p"), "id")).alias("product")
    )
    assert hot_keys(frame, "product", 9) == {"hot": 3}
