"""Batch readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    location: str,
    schema: T.StructType | None = None,
    table_format: str = "parquet",
) -> DataFrame:
    """Scan a table by path.

    Passing the schema keeps partition values such as hour `05` as written text; without
    it Spark would guess dates and integers. Folder levels that are no columns of it are left out.
    """
    reader = spark.read.format(table_format)
    if schema is None:
        return reader.load(location)
    return reader.schema(schema).load(location).select(*schema.fieldNames())


# Fixed value: the name of the partition of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def read_days(
    spark: SparkSession,
    location: str,
    schema: T.StructType,
    days: Sequence[str],
    table_format: str = "parquet",
) -> DataFrame:
    """Some days of a table of folders whose first level is `dt`; the files of other days are not even listed."""
    reader = spark.read.format(table_format).schema(schema).option("basePath", location)
    try:
        found = reader.load(f"{location}/dt={{{','.join(days)}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found.select(*schema.fieldNames())


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table by name from whichever catalog the session has (Hive, Iceberg, ...)."""
    return spark.read.table(name)


def read_documents(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """Scan exported documents, one JSON object per line, with a declared schema."""
    return spark.read.schema(schema).json(location)


def partition_scan(table: DataFrame, day: str) -> DataFrame:
    """One day of a table partitioned by `dt`; other partitions are never listed for reading."""
    return table.filter(F.col("dt") == F.lit(day))


def generated_ids(spark: SparkSession, first: int, last: int, name: str = "user_id") -> DataFrame:
    """Consecutive ids from `first` to `last`, both included."""
    return spark.range(first, last + 1).select(F.col("id").alias(name))
