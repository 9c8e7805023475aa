"""Creating and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Folder level below the partitions of a table, with the query and the micro-batch that wrote them.
BATCH = "batch"

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    properties: dict[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Create the table unless it is there; an existing one is left as it is."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in schema
    )
    clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({columns})", f"USING {table_format}"]
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(partition_by)})")
    if location is not None:
        clauses.append(f"LOCATION '{location}'")
    if properties:
        listed = ", ".join(f"'{key}'='{value}'" for key, value in properties.items())
        clauses.append(f"TBLPROPERTIES ({listed})")
    spark.sql(" ".join(clauses))


def balanced(
    rows: DataFrame, partition_by: Sequence[str], spread: int | None = None
) -> DataFrame:
    """Bring the rows of a table partition together so that each gets few files.

    The rebalance hint lets adaptive execution split a partition value that holds a large
    share of the rows, and merge the small ones. `spread` is the number of shuffle partitions
    to start from; a load of more table partitions than the session's number of shuffle
    partitions needs it, or several of them are split as one and into small files.
    """
    if not partition_by:
        return rows
    counted = [] if spread is None else [spread]
    return rows.hint("rebalance", *counted, *partition_by)


def ensure_folder(spark: SparkSession, path: str, schema: T.StructType, table_format: str = "parquet") -> None:
    """Make the folder of a table that may not have any rows yet, without a file in it."""
    none = spark.createDataFrame([], schema).write.format(table_format).mode("append")
    none.partitionBy(schema.fieldNames()[-1]).save(path)


def append(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    spread: int | None = None,
) -> None:
    writer = balanced(rows, partition_by, spread).write.format(table_format).mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def overwrite_partitions(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("dt",),
    table_format: str = "parquet",
    spread: int | None = None,
    balance: bool = True,
) -> None:
    """Replace exactly the partitions present in `rows`; the others stay untouched.

    Running it again with the same rows changes nothing. Rows that are all gone leave
    their old partition in place.
    """
    (
        (balanced(rows, partition_by, spread) if balance else rows)
        .write.format(table_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def overwrite_batch(
    rows: DataFrame,
    path: str,
    batch: str,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
) -> None:
    """Put the rows of one batch into its own folder of each table partition, in place of what it wrote before.

    The folders of a partition stay below it, so reading a day lists that day and no other. Files are written
    aside and moved when all of them are there.
    """
    named = balanced(rows, partition_by).withColumn(BATCH, F.lit(batch))
    overwrite_partitions(named, path, (*partition_by, BATCH), table_format, balance=False)


def overwrite_day(
    rows: DataFrame,
    path: str,
    day: str,
    day_column: str = "dt",
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Replace the partition of one day by the rows of that day, also where there are none left.

    `partition_by` are the levels below the day.
    """
    own = rows.filter(F.col(day_column) == day).drop(day_column)
    writer = own.hint("rebalance", *partition_by).write.format(table_format).mode("overwrite")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.save(f"{path}/{day_column}={day}")


def overwrite_catalog_day(rows: DataFrame, table: str, day: str, day_column: str = "dt") -> None:
    """The same in a table of a catalog."""
    spark = rows.sparkSession
    columns = [name for name in spark.read.table(table).columns if name != day_column]
    own = rows.filter(F.col(day_column) == day).select(*columns)
    quoted = day.replace("'", "")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({day_column} = '{quoted}') ({', '.join(columns)}) "
        "SELECT * FROM {own}",
        own=own,
    )


def _in_table_order(rows: DataFrame, table: str, partition_by: Sequence[str]) -> DataFrame:
    ordered = rows.select(*rows.sparkSession.read.table(table).columns)
    return balanced(ordered, partition_by)


def append_catalog_table(rows: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    _in_table_order(rows, table, partition_by).write.insertInto(table)


def overwrite_catalog_partitions(
    rows: DataFrame, table: str, partition_by: Sequence[str] = ("dt",)
) -> None:
    """Replace exactly the partitions present in `rows` in a table of a catalog.

    Tables of files take the mode of overwriting from the write, tables with their own
    metadata from the session; it is set for both.
    """
    conf = rows.sparkSession.conf
    before = conf.get(_OVERWRITE_MODE)
    conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        _in_table_order(rows, table, partition_by).write.insertInto(table, overwrite=True)
    finally:
        conf.set(_OVERWRITE_MODE, before)
