"""Daily marts and summaries.

Aggregates add up measures (see `functions.money`), so those without the hour give the same
result from single events and from the `daily_cube`, in which the events of a product are
already added up. Lookups in a large catalog happen after adding up per product: a product
that holds a third of all events is then one row per day and event type. Copies of a catalog
entry are counted rather than joined one by one, so many events never meet many copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions import money
from tidemart.operators.events import catalog_names, known_category
from tidemart.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup
from tidemart.operators.ranking import ranked
from tidemart.schemas import (
    DAILY_REVENUE,
    HOURLY_COUNTS,
    PURCHASE,
    REVENUE_BY_CATEGORY,
    TOP_PRODUCTS,
)
from tidemart.sources.federation import federated_query

_LISTINGS = "listings"


def summed_cube(measures: DataFrame) -> DataFrame:
    """The `daily_cube` from measures that are kept."""
    return measures.groupBy("dt", "event_type", "product").agg(*money.summed_measures())


def with_measures(events: DataFrame) -> DataFrame:
    """Events reduced to the mart dimensions plus the measures of a single event.

    The stored category is left out: marts take it from the catalog of today.
    """
    return events.select("dt", "hr", "event_type", "product", *money.row_measures(F.col("amount")))


def daily_cube(events: DataFrame) -> DataFrame:
    """Measures per day, event type and product: one scan for the marts about products.

    The hour is left out, which would make the cube up to 24 times larger; counting by hour
    reads no other column than the event type.
    """
    return summed_cube(with_measures(events))


def hourly_measures(events: DataFrame) -> DataFrame:
    """Measures per day, hour, event type and product: what is kept of a micro-batch for the marts.

    A micro-batch spans few hours, so the hour adds few rows. Measures of many micro-batches add up to those
    of all their events.
    """
    keys = ("dt", "hr", "event_type", "product")
    return with_measures(events).groupBy(*keys).agg(*money.summed_measures())


def catalog_listings(products: DataFrame) -> DataFrame:
    """Names and categories of the catalog with the number of entries that have both."""
    return catalog_names(products).groupBy("product", "category").agg(F.count("*").alias(_LISTINGS))


_TIMES_LISTED = f"coalesce({_LISTINGS}, 1)"


def revenue_by_category(
    facts: DataFrame,
    products: DataFrame,
    broadcast_limit: int = BROADCAST_BYTES,
    listings: DataFrame | None = None,
) -> DataFrame:
    """Events, revenue and average amount per day, category and event type.

    `facts` carries measures. The average is over all events of the group with an amount.
    `listings` are the `catalog_listings` of the products where they are at hand.
    """
    listings = catalog_listings(products) if listings is None else listings
    if fits_broadcast(listings, broadcast_limit):
        labelled = facts.join(F.broadcast(listings), "product", "left")
    else:
        per_product = facts.groupBy("dt", "event_type", "product").agg(*money.summed_measures())
        labelled = per_product.join(listings.hint("merge"), "product", "left")
    return (
        labelled.withColumn("category", known_category(F.col("category")))
        .groupBy("dt", "category", "event_type")
        .agg(*money.summed_measures(_TIMES_LISTED))
        .withColumn("total_revenue", money.total())
        .withColumn("avg_order", money.average())
        .select(*REVENUE_BY_CATEGORY.fieldNames())
    )


def daily_revenue(revenue: DataFrame) -> DataFrame:
    """The revenue mart without the average."""
    return revenue.select(*DAILY_REVENUE.fieldNames())


def top_products(
    facts: DataFrame,
    products: DataFrame,
    broadcast_limit: int = BROADCAST_BYTES,
    listings: DataFrame | None = None,
) -> DataFrame:
    """Orders and revenue per day, product and category, purchases only.

    A product name listed under several categories counts under each of them.
    """
    listings = catalog_listings(products) if listings is None else listings
    sold = (
        facts.filter(F.col("event_type") == PURCHASE)
        .groupBy("dt", "product")
        .agg(*money.summed_measures())
    )
    labelled = lookup(sold, listings, "product", broadcast_limit=broadcast_limit)
    return (
        labelled.withColumn("category", known_category(F.col("category")))
        .groupBy("dt", "product", "category")
        .agg(*money.summed_measures(_TIMES_LISTED))
        .select(
            "dt",
            "product",
            "category",
            F.col(money.EVENT_COUNT).alias("orders"),
            money.total().alias("revenue"),
        )
        .select(*TOP_PRODUCTS.fieldNames())
    )


def by_revenue(mart: DataFrame) -> DataFrame:
    """The product mart with the best seller first; equal revenue sorts by day and name."""
    return mart.orderBy(F.col("revenue").desc_nulls_last(), "dt", "product", "category")


def best_sellers(mart: DataFrame, count: int) -> DataFrame:
    """The `count` products of each day with the most revenue, with their rank.

    Every task keeps its own best `count` rows per day before the shuffle, so the ranking
    of a day never gathers all its products.
    """
    order = [F.col("revenue").desc_nulls_last(), F.col("product"), F.col("category")]
    ranked = mart.withColumn("rank", F.row_number().over(W.partitionBy("dt").orderBy(*order)))
    return ranked.filter(F.col("rank") <= count)


def with_rank(mart: DataFrame) -> DataFrame:
    """The product mart with the rank of every product in its day, the best seller first.

    A day of any number of products is ranked by many tasks (see `ranking`).
    """
    order = [F.col("revenue").desc_nulls_last(), F.col("product"), F.col("category")]
    return ranked(mart, ["dt"], order)


def hourly_counts(facts: DataFrame) -> DataFrame:
    """Events per day, hour and event type."""
    return (
        facts.groupBy("dt", "hr", "event_type")
        .agg(F.sum(money.EVENT_COUNT).alias("event_count"))
        .select(*HOURLY_COUNTS.fieldNames())
    )


def event_type_summary(facts: DataFrame) -> DataFrame:
    """Count and revenue per event type, most frequent first."""
    return (
        facts.groupBy("event_type")
        .agg(*money.summed_measures())
        .select("event_type", F.col(money.EVENT_COUNT).alias("cnt"), money.total().alias("revenue"))
        .orderBy(F.col("cnt").desc(), "event_type")
    )


# Sales are added up per product before the catalog is joined, so the join sees one row per
# product whatever the size of either source, and both sides may be shuffled cheaply.
_SUMS = ", ".join(f"sum({name}) AS {name}" for name in money.MEASURES)
_AMOUNTS = (*money.AMOUNT_CENTS, money.AMOUNT_RESIDUE)
_WEIGHTED = ", ".join(f"{money.weighted_sql(name, _LISTINGS)} AS {name}" for name in _AMOUNTS)
_SALES_BY_PRODUCT = f"""
WITH sold AS (
    SELECT product, {_SUMS} FROM {{events}} WHERE event_type = 'purchase' GROUP BY product
),
catalog AS (
    SELECT name, category, count(*) AS {_LISTINGS} FROM {{products}} GROUP BY name, category
),
listed AS (
    SELECT product, category,
           CAST({money.weighted_sql(money.EVENT_COUNT, _LISTINGS)} AS BIGINT) AS orders, {_WEIGHTED}
    FROM sold JOIN catalog ON product = name
    GROUP BY product, category
)
SELECT product, category, orders, {money.TOTAL_SQL} AS revenue FROM listed
"""


def sales_by_product(spark: SparkSession, facts: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases by product and category across two sources; unlisted products are left out."""
    return federated_query(spark, _SALES_BY_PRODUCT, events=facts, products=products)


def top_sales(spark: SparkSession, facts: DataFrame, products: DataFrame, count: int = 5) -> DataFrame:
    """The `count` rows of `sales_by_product` with the most revenue."""
    sales = sales_by_product(spark, facts, products)
    return sales.orderBy(F.col("revenue").desc_nulls_last(), "product", "category").limit(count)
