from __future__ import annotations

import pytest
from fixtures import catalog, exchanges, facts, plan

from tidemart.operators import marts
from tidemart.schemas import HOURLY_COUNTS, REVENUE_BY_CATEGORY, TOP_PRODUCTS

EVENTS = [
    (1, "purchase", "laptop", 1299.99, "2024-03-01", "10"),
    (2, "purchase", "laptop", 1299.99, "2024-03-01", "11"),
    (3, "purchase", "phone", 899.99, "2024-03-01", "11"),
    (4, "view", "phone", 0.0, "2024-03-01", "11"),
    (5, "purchase", "gone", 5.55, "2024-03-01", "11"),
    (6, "purchase", None, 4.45, "2024-03-01", "11"),
    (7, "purchase", "mouse", None, "2024-03-02", "00"),
    (8, "purchase", "mouse", 49.99, "2024-03-02", "00"),
    (9, "wishlist", "speaker", 0.0, "2024-03-02", "23"),
]


@pytest.fixture(scope="module", params=["events", "cube"])
def measured(request, spark):
    rows = facts(spark, EVENTS)
    return marts.with_measures(rows) if request.param == "events" else marts.daily_cube(rows)


@pytest.mark.parametrize("limit", [marts.BROADCAST_BYTES, 0])
def test_revenue_by_category(spark, measured, limit):
    frame = marts.revenue_by_category(measured, catalog(spark), limit)
    assert [f.dataType for f in frame.schema] == [f.dataType for f in REVENUE_BY_CATEGORY]
    assert {tuple(row) for row in frame.collect()} == {
        ("2024-03-01", "electronics", "purchase", 3, 3499.97, 1166.66),
        ("2024-03-01", "electronics", "view", 1, 0.0, 0.0),
        ("2024-03-01", "unknown", "purchase", 2, 10.0, 5.0),
        ("2024-03-02", "peripherals", "purchase", 2, 49.99, 49.99),
        ("2024-03-02", "audio", "wishlist", 1, 0.0, 0.0),
    }
    assert marts.daily_revenue(frame).columns == REVENUE_BY_CATEGORY.fieldNames()[:-1]


@pytest.mark.parametrize("limit", [marts.BROADCAST_BYTES, 0])
def test_top_products(spark, measured, limit):
    frame = marts.top_products(measured, catalog(spark), limit)
    assert [f.dataType for f in frame.schema] == [f.dataType for f in TOP_PRODUCTS]
    assert {tuple(row) for row in frame.collect()} == {
        ("2024-03-01", "laptop", "electronics", 2, 2599.98),
        ("2024-03-01", "phone", "electronics", 1, 899.99),
        ("2024-03-01", "gone", "unknown", 1, 5.55),
        ("2024-03-01", None, "unknown", 1, 4.45),
        ("2024-03-02", "mouse", "peripherals", 2, 49.99),
    }
    assert [row["product"] for row in marts.by_revenue(frame).collect()] == [
        "laptop", "phone", "mouse", "gone", None
    ]
    best = {(row["dt"], row["rank"]): row["product"] for row in marts.best_sellers(frame, 2).collect()}
    assert best == {
        ("2024-03-01", 1): "laptop", ("2024-03-01", 2): "phone", ("2024-03-02", 1): "mouse"
    }


@pytest.mark.parametrize("limit", [marts.BROADCAST_BYTES, 0])
def test_names_listed_twice_count_under_each_category(spark, measured, limit):
    products = spark.createDataFrame(
        [("laptop", "a"), ("laptop", "b"), ("laptop", "b")], "name string, category string"
    )
    rows = marts.top_products(measured, products, limit).filter("product = 'laptop'").collect()
    assert {(row["category"], row["orders"], row["revenue"]) for row in rows} == {
        ("a", 2, 2599.98), ("b", 4, 5199.96)
    }
    revenue = marts.revenue_by_category(measured, products, limit).filter("category = 'b'").first()
    assert (revenue["event_count"], revenue["total_revenue"], revenue["avg_order"]) == (4, 5199.96, 1299.99)
    sales = marts.top_sales(spark, measured, products).collect()
    assert [(row["category"], row["orders"], row["revenue"]) for row in sales] == [
        ("b", 4, 5199.96), ("a", 2, 2599.98)
    ]


@pytest.mark.parametrize("limit", [marts.BROADCAST_BYTES, 0])
def test_copies_of_an_entry_are_not_joined_one_by_one(spark, limit):
    events = facts(spark, EVENTS[:1] * 1000)
    copies = spark.range(3000).selectExpr("'laptop' AS name", "'a' AS category")
    row, = marts.revenue_by_category(marts.with_measures(events), copies, limit).collect()
    assert (row["event_count"], row["avg_order"]) == (3_000_000, 1299.99)
    row, = marts.top_products(marts.with_measures(events), copies, limit).collect()
    assert row["orders"] == 3_000_000
    assert "listings" in plan(marts.top_products(marts.with_measures(events), copies, limit))


def test_hourly_counts(spark):
    frame = marts.hourly_counts(marts.with_measures(facts(spark, EVENTS)))
    assert [f.dataType for f in frame.schema] == [f.dataType for f in HOURLY_COUNTS]
    rows = {tuple(row)[:3]: row["event_count"] for row in frame.collect()}
    assert rows[("2024-03-01", "11", "purchase")] == 4
    assert rows[("2024-03-02", "00", "purchase")] == 2
    assert sum(rows.values()) == len(EVENTS)


def test_event_type_summary_is_sorted(spark, measured):
    rows = [tuple(row) for row in marts.event_type_summary(measured).collect()]
    assert rows == [("purchase", 7, 3559.96), ("view", 1, 0.0), ("wishlist", 1, 0.0)]


def test_top_sales_leaves_out_unlisted_products(spark, measured):
    rows = [tuple(row) for row in marts.top_sales(spark, measured, catalog(spark), 5).collect()]
    assert rows == [
        ("laptop", "electronics", 2, 2599.98), ("phone", "electronics", 1, 899.99),
        ("mouse", "peripherals", 2, 49.99),
    ]
    assert marts.top_sales(spark, measured, catalog(spark), 1).count() == 1


def test_plans(spark):
    measures = marts.with_measures(facts(spark, EVENTS))
    revenue = marts.revenue_by_category(measures, catalog(spark))
    # One shuffle of facts, one of the catalog.
    assert "BroadcastHashJoin" in plan(revenue) and exchanges(revenue) == 2
    best = marts.top_products(measures, catalog(spark))
    assert "BroadcastHashJoin" in plan(best) and exchanges(best) == 2
    assert "rangepartitioning" not in plan(best)
    for frame in (revenue, best, marts.daily_cube(facts(spark, EVENTS))):
        assert "SortAggregate" not in plan(frame)
    assert "WindowGroupLimit" in plan(marts.best_sellers(best, 3))
    assert "TakeOrderedAndProject" in plan(marts.top_sales(spark, measures, catalog(spark)))


def test_the_category_stored_at_ingest_is_not_used(spark):
    stored = facts(spark, EVENTS).selectExpr("*", "'old' AS category")
    revenue = marts.revenue_by_category(marts.with_measures(stored), catalog(spark))
    assert revenue.filter("category = 'old'").isEmpty() and revenue.count() == 5


def test_large_catalogs_are_not_broadcast_by_the_marts(spark, measured):
    for frame in (marts.revenue_by_category(measured, catalog(spark), 0), marts.top_products(measured, catalog(spark), 0)):
        text = plan(frame)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
