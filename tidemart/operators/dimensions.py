"""Dimension tables: the product view, customers, and inserting what is not there yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import bands
from tidemart.operators.lookup import BROADCAST_BYTES, fits_broadcast
from tidemart.operators.ranking import ranked
from tidemart.session import checkpointed


def product_defaults() -> dict[str, Column]:
    return {
        "stock": F.lit(0),
        "active": F.lit(True),
        "created_at": F.current_timestamp(),
    }


def customer_defaults() -> dict[str, Column]:
    return {
        "tier": F.lit("bronze"),
        "country": F.lit("US"),
        "joined_at": F.current_timestamp(),
    }


def product_summary(products: DataFrame) -> DataFrame:
    """The catalog with the stock band of each product."""
    return products.select(
        "name",
        "category",
        "base_price",
        "stock",
        bands.stock_band(F.col("stock")).alias("availability"),
    )


def customer_rows(ids: DataFrame) -> DataFrame:
    """Customers for a table of `user_id`, their attributes derived from the id."""
    user_id = F.col("user_id")
    return ids.select(
        "user_id",
        bands.customer_email(user_id).alias("email"),
        bands.customer_tier(user_id).alias("tier"),
        bands.customer_country(user_id).alias("country"),
    )


def with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill in columns the rows do not have. A NULL that is there stays."""
    missing = {name: value for name, value in defaults.items() if name not in rows.columns}
    return rows.withColumns(missing) if missing else rows


def with_required(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Leave out rows with a NULL in a required column."""
    return rows.dropna("any", subset=list(required)) if required else rows


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the least of its rows, so that reruns choose the same one.

    Each task first picks among its own rows, so copies of one key do not pile up.
    """
    others = [name for name in rows.columns if name not in keys]
    if not others:
        return rows.distinct()
    least = F.min(F.struct(*others)).alias("_least")
    return rows.groupBy(*keys).agg(least).select(*keys, "_least.*").select(*rows.columns)


def absent_rows(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row for each key of `incoming` that `existing` lacks."""
    # Written once: measured, joined and, for serial numbers, counted from there.
    candidates = checkpointed(one_per_key(incoming, keys))
    present = existing.select(*keys)
    wanted = candidates.select(*keys)
    if fits_broadcast(wanted, broadcast_limit):
        # Few new rows: the existing table is filtered where it lies instead of shuffled.
        present = present.join(F.broadcast(wanted), list(keys), "left_semi")
    # Copies of a key are dropped before the shuffle the anti join needs anyway.
    return candidates.join(present.distinct(), list(keys), "left_anti")


def rows_to_insert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    required: Sequence[str] = (),
    defaults: dict[str, Column] | None = None,
    serial: str | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows an insert that skips conflicts adds to `existing`, in its column order.

    `keys` say what a conflict is. `serial` names a column to number the new rows with.
    Columns of `existing` with neither a value nor a default are NULL.
    """
    complete = with_required(with_defaults(incoming, defaults or {}), required)
    fresh = absent_rows(existing, complete, keys, broadcast_limit)
    if serial is not None:
        fresh = with_serial(fresh, keys, serial, last_serial(existing, serial))
    kinds = {field.name: field.dataType for field in existing.schema}
    return fresh.select(
        *[
            (F.col(name) if name in fresh.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ]
    )


def last_serial(existing: DataFrame, serial: str) -> int:
    """The highest number used so far, 0 for an empty table."""
    return existing.agg(F.coalesce(F.max(serial), F.lit(0)).alias("last")).first()["last"]


def with_serial(rows: DataFrame, keys: Sequence[str], serial: str, last: int) -> DataFrame:
    """Number rows without gaps from `last + 1` in the order of their keys, which must be unique."""
    numbered = ranked(rows, [], list(keys), serial)
    return numbered.withColumn(serial, F.col(serial) + F.lit(last))
