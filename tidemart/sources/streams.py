"""Event streams. Each has a `value` column holding one JSON object per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """`starting_offsets` only matters for a query that has no checkpoint yet.

    `max_offsets_per_trigger` bounds a micro-batch after an outage, and `min_partitions`
    reads a topic of few partitions with more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Needs Spark's Kafka package on the cluster."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **settings)).load()


def file_stream(
    spark: SparkSession,
    directory: str,
    file_format: str = "text",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Files appearing in a folder: text, one record per line, or parquet with a binary `value`."""
    reader = spark.readStream.format(file_format)
    reader = reader.schema("value string" if file_format == "text" else "value binary")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)
