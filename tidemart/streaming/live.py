"""The newest sample of every series, kept in a table while samples stream in.

The table is the state: each micro-batch is reduced to its newest sample per series and merged with what the
table holds of these series, by the order of the samples. A sample that comes late changes nothing, and a
repeated micro-batch changes nothing either, so it does not matter how often, or in which parts, samples come.

Series are dealt to a fixed number of buckets, which are the partitions of the table. A micro-batch reads and
replaces the buckets it has series of; one row for each series is all that is ever kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.metrics import sample_order
from tidemart.sinks.tables import overwrite_partitions

BUCKET = "bucket"
# Fixed for a table once it has rows; about one for every ten million series.
BUCKETS = 64

_LATEST = "_latest"


def newest_samples(samples: DataFrame, series: Sequence[str], tie_break: str) -> DataFrame:
    """The last sample of each series that has a value and a time, whole: ts, value and `tie_break`.

    Of equal times and tie-breaks the higher value is the later one.
    """
    present = samples.filter(F.col("value").isNotNull() & F.col("ts").isNotNull() & F.col(tie_break).isNotNull())
    order = F.struct(sample_order(F.col("ts"), F.col(tie_break)).alias("at"), F.col("value").alias("last"))
    sample = F.struct("ts", "value", tie_break)
    newest = present.groupBy(*series).agg(F.max_by(sample, order).alias(_LATEST))
    return newest.select(*series, *[F.col(f"{_LATEST}.{name}").alias(name) for name in ("ts", "value", tie_break)])


def read_newest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the table holds; no rows before the first micro-batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def merge_newest(samples: DataFrame, path: str, series: Sequence[str], tie_break: str, buckets: int = BUCKETS) -> None:
    """Merge samples into the table at `path`, which has one writer."""
    bucket = F.pmod(F.xxhash64(*series), F.lit(buckets)).cast("int").alias(BUCKET)
    fresh = newest_samples(samples, series, tie_break).select("*", bucket).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = [row[BUCKET] for row in fresh.select(BUCKET).distinct().collect()]
        if not touched:
            return
        kept = read_newest(samples.sparkSession, path, fresh.schema).where(F.col(BUCKET).isin(touched))
        merged = newest_samples(kept.unionByName(fresh), [*series, BUCKET], tie_break)
        overwrite_partitions(merged, path, (BUCKET,))
    finally:
        fresh.unpersist()


def start_newest(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    series: Sequence[str],
    tie_break: str,
    every: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the newest sample of every series of a stream in the table at `path`.

    Without `every` the run takes what is there and ends.
    """
    writer = samples.writeStream.queryName("newest_samples").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.foreachBatch(lambda batch, _: merge_newest(batch, path, series, tie_break, buckets)).start()
