"""Where a deployment keeps its tables: in folders, or in a catalog."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart import schemas
from tidemart.sinks import tables as sinks
from tidemart.sources import tables as sources


@dataclass(frozen=True)
class Table:
    namespace: str
    name: str
    schema: T.StructType
    partition_by: Sequence[str] = ()


# Namespaces and names. Event measures and quality states are this library's own.
EVENTS = Table("events", "user_events", schemas.USER_EVENTS, schemas.USER_EVENTS_PARTITIONS)
EVENT_MEASURES = Table("analytics", "event_measures", schemas.EVENT_MEASURES, schemas.USER_EVENTS_PARTITIONS)
RAW_EVENTS = Table("db", "raw_events", schemas.RAW_EVENTS)
REVENUE = Table(
    "analytics", "daily_revenue_by_category", schemas.REVENUE_BY_CATEGORY, schemas.MART_PARTITIONS
)
TOP_PRODUCTS = Table("analytics", "top_products_daily", schemas.TOP_PRODUCTS, schemas.MART_PARTITIONS)
HOURLY = Table("analytics", "hourly_event_counts", schemas.HOURLY_COUNTS, schemas.MART_PARTITIONS)
DAILY_REVENUE = Table("analytics", "daily_revenue", schemas.DAILY_REVENUE, schemas.MART_PARTITIONS)
QUALITY_LOG = Table("quality", "data_quality_metrics", schemas.QUALITY_METRICS)
QUALITY_STATES = Table("quality", "quality_states", schemas.QUALITY_STATES, schemas.MART_PARTITIONS)
TABLES = (EVENTS, RAW_EVENTS, REVENUE, TOP_PRODUCTS, HOURLY, DAILY_REVENUE, QUALITY_LOG, QUALITY_STATES)


# Formats whose tables are just the files of a folder.
FILE_FORMATS = ("parquet", "orc", "avro", "json")


@dataclass(frozen=True)
class FolderLayout:
    """Every table is a folder below `root` with a single writer.

    `spread` is the number of shuffle partitions that writes start from.
    """

    root: str
    table_format: str = "parquet"
    spread: int | None = None
    as_table = False

    def __post_init__(self) -> None:
        # Overwriting by partition would replace whole tables of formats with their own metadata.
        if self.table_format not in FILE_FORMATS:
            raise ValueError(f"{self.table_format} tables belong into a catalog, not into folders")

    def place(self, table: Table) -> str:
        return f"{self.root}/{table.namespace}/{table.name}"

    def checkpoint(self, table: Table) -> str:
        return f"{self.root}/checkpoints/{table.name}"

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        return sources.read_table(spark, self.place(table), table.schema, self.table_format)

    def read_days(self, spark: SparkSession, table: Table, days: Sequence[str]) -> DataFrame:
        """Days of a table partitioned by `dt` first, without a look at the others."""
        return sources.read_days(spark, self.place(table), table.schema, days, self.table_format)

    def append(self, rows: DataFrame, table: Table) -> None:
        sinks.append(rows, self.place(table), table.partition_by, self.table_format, self.spread)

    def replace_partitions(self, rows: DataFrame, table: Table) -> None:
        sinks.overwrite_partitions(
            rows, self.place(table), table.partition_by, self.table_format, self.spread
        )

    def replace_day(self, rows: DataFrame, table: Table, day: str) -> None:
        sinks.overwrite_day(rows, self.place(table), day, table_format=self.table_format)


@dataclass(frozen=True)
class CatalogLayout:
    """Every table is one of a catalog; `checkpoints` is a folder for the streams.

    Meant for table formats with their own metadata, such as Iceberg. `prepare` creates
    what is missing.
    """

    checkpoints: str
    catalog: str | None = None
    table_format: str = "iceberg"
    as_table = True

    def place(self, table: Table) -> str:
        parts = [self.catalog, table.namespace, table.name]
        return ".".join(part for part in parts if part)

    def checkpoint(self, table: Table) -> str:
        return f"{self.checkpoints}/{table.name}"

    def prepare(self, spark: SparkSession, properties: dict[str, str] | None = None) -> None:
        for table in TABLES:
            sinks.ensure_namespace(spark, self.place(table).rsplit(".", 1)[0])
            sinks.ensure_table(
                spark, self.place(table), table.schema, table.partition_by, self.table_format, properties
            )

    def read(self, spark: SparkSession, table: Table) -> DataFrame:
        return sources.catalog_table(spark, self.place(table)).select(*table.schema.fieldNames())

    def read_days(self, spark: SparkSession, table: Table, days: Sequence[str]) -> DataFrame:
        day = F.col("dt")
        return self.read(spark, table).where(F.coalesce(day, F.lit(sources.NO_DAY)).isin(*days))

    def append(self, rows: DataFrame, table: Table) -> None:
        sinks.append_catalog_table(rows, self.place(table), table.partition_by)

    def replace_partitions(self, rows: DataFrame, table: Table) -> None:
        sinks.overwrite_catalog_partitions(rows, self.place(table), table.partition_by)

    def replace_day(self, rows: DataFrame, table: Table, day: str) -> None:
        sinks.overwrite_catalog_day(rows, self.place(table), day)
