"""One SQL statement over several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(spark: SparkSession, **sources: DataFrame) -> None:
    """Name each source for later SQL; a name already taken is replaced."""
    for name, source in sources.items():
        source.createOrReplaceTempView(name)


def federated_query(spark: SparkSession, statement: str, **sources: DataFrame) -> DataFrame:
    """Run SQL that names its sources in braces, as in `SELECT * FROM {events}`.

    The sources may come from different readers. Their names exist during the call only.
    """
    return spark.sql(statement, **sources)
