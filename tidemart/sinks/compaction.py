"""Putting together the small files that micro-batches leave in one day of a table of folders.

The rows of all batches of the day are written aside first, in few files per hour. Then it is taken down which
batches they come from, and only then the folder of the day is replaced by them. A job that dies before the
note leaves the day as it was; one that dies after it is finished by the next call, from the files
written aside. A micro-batch that is repeated later finds itself in the notes and leaves the day alone.

Tables of folders have one writer: a day is compacted while no stream writes to the table. A reader that comes
while the folder is replaced may find it incomplete; formats with their own metadata do not have this limit.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sinks.tables import BATCH

# The batch that rows put together belong to.
MERGED = "merged"

_NOTES = "day string, batch string, state string, at timestamp"
READY, PUBLISHED = "ready", "published"


def _notes(spark: SparkSession, location: str) -> DataFrame:
    """What has been put together so far; folders whose name begins with an underscore are not read as data."""
    try:
        return spark.read.schema(_NOTES).parquet(f"{location}/_merged/notes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _NOTES)


def _note(rows: DataFrame, location: str, day: str, state: str) -> None:
    noted = rows.select(F.lit(day).alias("day"), BATCH, F.lit(state).alias("state"), F.current_timestamp().alias("at"))
    noted.coalesce(1).write.mode("append").parquet(f"{location}/_merged/notes")


def merged_days(spark: SparkSession, location: str, batch: str) -> list[str]:
    """Days in which the rows of a batch have been put together with others."""
    rows = _notes(spark, location).where((F.col(BATCH) == batch) & (F.col("state") == READY)).select("day").distinct()
    return [row["day"] for row in rows.collect()]


def _is_pending(spark: SparkSession, location: str, day: str) -> bool:
    """Whether the last thing noted of the day is that its files are ready."""
    own = _notes(spark, location).where(F.col("day") == day)
    last = own.agg(F.max_by("state", F.struct("at", F.col("state") == PUBLISHED)).alias("state")).first()
    return last["state"] == READY


def _publish(spark: SparkSession, location: str, day: str, schema: T.StructType, table_format: str) -> None:
    kept = spark.read.format(table_format).schema(schema).load(f"{location}/_merged/dt={day}")
    kept = kept.withColumn(BATCH, F.lit(MERGED)).drop("dt")
    levels = [name for name in ("hr",) if name in kept.columns]
    kept.write.format(table_format).mode("overwrite").partitionBy(*levels, BATCH).save(f"{location}/dt={day}")
    _note(spark.range(1).select(F.lit(MERGED).alias(BATCH)), location, day, PUBLISHED)


def compact_day(
    spark: SparkSession, location: str, day: str, schema: T.StructType, table_format: str = "parquet"
) -> bool:
    """Put the batches of one day together; whether there was anything to do.

    `schema` is that of the table, without the batch. Rows are cut into files by size, hour by hour.
    """
    pending = _is_pending(spark, location, day)
    if pending:
        _publish(spark, location, day, schema, table_format)
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    try:
        reader = spark.read.format(table_format).schema(with_batch).option("basePath", location)
        rows = reader.load(f"{location}/dt={day}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return pending
    fresh = rows.select(BATCH).distinct().where(F.col(BATCH) != MERGED)
    if fresh.isEmpty():
        return pending
    levels = [name for name in ("hr",) if name in schema.fieldNames()]
    packed = rows.drop(BATCH, "dt").hint("rebalance", *levels).write.format(table_format).mode("overwrite")
    (packed.partitionBy(*levels) if levels else packed).save(f"{location}/_merged/dt={day}")
    _note(fresh, location, day, READY)
    _publish(spark, location, day, schema, table_format)
    return True
