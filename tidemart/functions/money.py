"""Sums and averages of money that do not depend on the order of the rows.

Adding doubles gives last digits that change with the partitioning. Every amount is
therefore split into whole cents, added as integers, and the residue below a cent,
which is exactly 0.0 for amounts with two decimals. The cents travel as three integers of
18 bits (the highest keeps the sign), whose sums hold for 3.5e13 rows of a group whatever the
amounts. NaN, infinite and amounts beyond the range in which a double tells cents apart go to
the residue whole, so they show up in the result as they would in a plain sum. All parts
are additive, so partial results can be merged freely.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles hold whole cents exactly up to 2^53 of them.
_EXACT_BELOW = 2.0**53 / 100
_PART_BITS = 18

EVENT_COUNT = "event_count"
AMOUNT_COUNT = "amount_count"
AMOUNT_CENTS = ("amount_cents_high", "amount_cents_mid", "amount_cents_low")
AMOUNT_RESIDUE = "amount_residue"
MEASURES = (EVENT_COUNT, AMOUNT_COUNT, *AMOUNT_CENTS, AMOUNT_RESIDUE)

# Expressions over summed measures, for SQL texts as well.
_HIGH, _MID, _LOW = (f"CAST({name} AS DECIMAL(38, 0))" for name in AMOUNT_CENTS)
_UNIT = f"{1 << _PART_BITS}BD"
_CENTS_SQL = f"CAST(({_HIGH} * {_UNIT} + {_MID}) * {_UNIT} + {_LOW} AS DOUBLE)"
TOTAL_SQL = f"round({_CENTS_SQL} / 100.0D + {AMOUNT_RESIDUE}, 2)"
_WHOLE = "DECIMAL(38, 0)"


def cents(amount: Column) -> Column:
    in_range = F.abs(amount) < F.lit(_EXACT_BELOW)
    return F.when(in_range, F.rint(amount * 100)).otherwise(F.lit(0.0)).cast("long")


def residue(amount: Column) -> Column:
    return amount - cents(amount) / F.lit(100.0)


def row_measures(amount: Column) -> list[Column]:
    """The measures of a single event; NULL amounts count as events but not as amounts."""
    return [
        F.lit(1).cast("long").alias(EVENT_COUNT),
        amount.isNotNull().cast("long").alias(AMOUNT_COUNT),
        *_parts(cents(amount)),
        residue(amount).alias(AMOUNT_RESIDUE),
    ]


def _parts(whole: Column) -> list[Column]:
    mask = F.lit((1 << _PART_BITS) - 1)
    values = (
        F.shiftright(whole, 2 * _PART_BITS),
        F.shiftright(whole, _PART_BITS).bitwiseAND(mask),
        whole.bitwiseAND(mask),
    )
    return [value.alias(name) for value, name in zip(values, AMOUNT_CENTS, strict=True)]


def weighted_sql(name: str, times: str) -> str:
    """Sum of a measure over rows that each stand for `times`, without overflow."""
    if name == AMOUNT_RESIDUE:
        return f"sum({name} * {times})"
    return f"sum(CAST({name} AS {_WHOLE}) * CAST({times} AS {_WHOLE}))"


def summed_measures(times: str | None = None) -> list[Column]:
    """Sums of the measures; with `times`, an expression, of rows that each stand for that many."""
    if times is None:
        return [F.sum(name).alias(name) for name in MEASURES]
    counts = (EVENT_COUNT, AMOUNT_COUNT)
    return [
        F.expr(weighted_sql(name, times)).cast("long").alias(name)
        if name in counts
        else F.expr(weighted_sql(name, times)).alias(name)
        for name in MEASURES
    ]


def total() -> Column:
    """Sum of the amounts to two places, NULL where there is no amount."""
    return F.expr(TOTAL_SQL)


def average() -> Column:
    """Average of the amounts to two places: one division, so ties round up exactly."""
    hundredfold = F.expr(_CENTS_SQL) + F.col(AMOUNT_RESIDUE) * 100
    return F.when(
        F.col(AMOUNT_COUNT) > 0,
        F.round(hundredfold / (F.col(AMOUNT_COUNT) * 100).cast("double"), 2),
    )
