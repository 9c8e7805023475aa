"""Small helpers for native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use a value several times in an expression that computes it once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def named(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator needs, so that others cannot clash with its own."""
    kinds = {"doc_id": "long", "text": "string"}
    return docs.select(
        *[F.col(name).cast(kinds[name]).alias(name) if name in kinds else F.col(name) for name in columns]
    )


def set_apart(docs: DataFrame, used: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stage that reads `used` and may add columns of any name; the columns of docs, with their values."""
    hidden = {name: f"_own_{number}" for number, name in enumerate(docs.columns) if name not in used}
    done = stage(docs.withColumnsRenamed(hidden))
    return done.select(*[F.col(hidden.get(name, name)).alias(name) for name in docs.columns])
