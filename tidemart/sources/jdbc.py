"""Reading relations over JDBC; the driver jar comes from the cluster."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSplit:
    """How to read a large relation with several tasks: value ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split: JdbcSplit | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split is not None:
        options.update(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=str(split.partitions),
        )
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    properties: dict[str, str] | None = None,
    split: JdbcSplit | None = None,
) -> DataFrame:
    """The named columns of a relation; columns and filters are evaluated by the database.

    Without `split` the relation is read by one task, which suits small dimensions only.
    """
    options = jdbc_options(url, table, properties, split)
    return spark.read.format("jdbc").options(**options).load().select(*columns)
