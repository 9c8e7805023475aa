"""Bands, tiers and units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stock bands, customer tiers and countries.
IN_STOCK_ABOVE = 100
LOW_STOCK_ABOVE = 0
COUNTRIES = ("US", "UK", "IN", "DE", "AU")

# Dashboard colours as (base colour, ((lower bound, colour), ...)).
MESSAGE_RATE_BANDS = ("green", ((100, "yellow"), (500, "red")))
RUNNING_JOBS_BANDS = ("red", ((1, "green"),))


def stock_band(stock: Column) -> Column:
    """`in_stock`, `low_stock` or `out_of_stock`; NULL stock is out of stock."""
    return (
        F.when(stock > IN_STOCK_ABOVE, "in_stock")
        .when(stock > LOW_STOCK_ABOVE, "low_stock")
        .otherwise("out_of_stock")
    )


def customer_tier(user_id: Column) -> Column:
    return F.when(user_id % 10 == 0, "gold").when(user_id % 5 == 0, "silver").otherwise("bronze")


def customer_email(user_id: Column) -> Column:
    return F.concat(F.lit("user"), user_id.cast("string"), F.lit("@example.com"))


def customer_country(user_id: Column) -> Column:
    """NULL for ids whose remainder is negative, which have no place in the list."""
    countries = F.array(*[F.lit(code) for code in COUNTRIES])
    return F.get(countries, (user_id % len(COUNTRIES)).cast("int"))


def threshold_band(value: Column, bands: tuple[str, Sequence[tuple[float, str]]]) -> Column:
    """The colour of the highest bound reached; NULL for a missing value."""
    base, steps = bands
    colour = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in sorted(steps, reverse=True):
        colour = colour.when(value >= bound, name)
    return colour.otherwise(base)


def gibibytes(size: Column) -> Column:
    return size / 1024 / 1024 / 1024
