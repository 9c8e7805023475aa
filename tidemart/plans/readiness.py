"""Whether a source has anything newer than the last run that ended well."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Time of a record as the probe sees it.
ARRIVED = "arrived"

# What is newer than a time, or everything without one, with a column `ARRIVED`.
RecordsAfter = Callable[[datetime | None], DataFrame]


class HighWater:
    """The newest time ingested so far, kept in a folder next to the checkpoints.

    `probe` reads records newer than the mark only, and `keep` moves the mark up to the newest of them. It is
    called when a run has ended well, so a failed run is tried again. A source that cannot be read is not
    ready.
    """

    def __init__(self, spark: SparkSession, folder: str, records_after: RecordsAfter) -> None:
        self.spark, self.folder, self.records_after = spark, folder, records_after
        self.newest: datetime | None = None

    def mark(self) -> datetime | None:
        try:
            marks = self.spark.read.schema("mark timestamp").parquet(self.folder)
            return marks.agg(F.max("mark").alias("mark")).first()["mark"]
        except PySparkException:
            return None

    def probe(self) -> bool:
        mark = self.mark()
        try:
            records = self.records_after(mark)
            newer = records if mark is None else records.where(F.col(ARRIVED) > F.lit(mark))
            self.newest = newer.agg(F.max(ARRIVED).cast("timestamp").alias("newest")).first()["newest"]
        except (PySparkException, Py4JJavaError) as error:
            log.warning("source not ready: %s", str(error).splitlines()[0])
            self.newest = None
        return self.newest is not None

    def keep(self) -> None:
        if self.newest is not None:
            row = self.spark.createDataFrame([(self.newest,)], "mark timestamp")
            # Not as JSON, which cuts times to milliseconds.
            row.coalesce(1).write.mode("append").parquet(self.folder)


def files_after(spark: SparkSession, folder: str) -> RecordsAfter:
    """Files by the time they were last changed; older ones are left out when the folder is listed."""

    def records(mark: datetime | None) -> DataFrame:
        reader = spark.read
        if mark is not None:
            utc = datetime.fromtimestamp(mark.timestamp(), timezone.utc)
            reader = reader.option("modifiedAfter", utc.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
        return reader.text(folder).select(F.col("_metadata.file_modification_time").alias(ARRIVED))

    return records


def kafka_after(spark: SparkSession, servers: str, topic: str) -> RecordsAfter:
    """Records by the time the broker has of them; reading starts at the mark."""

    def records(mark: datetime | None) -> DataFrame:
        reader = spark.read.format("kafka").options(**kafka_probe_options(servers, topic, mark))
        return reader.load().select(F.col("timestamp").alias(ARRIVED))

    return records


def kafka_probe_options(servers: str, topic: str, mark: datetime | None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if mark is not None:
        options |= {"startingTimestamp": str(int(mark.timestamp() * 1000)), "startingOffsetsByTimestampStrategy": "latest"}
    return options
