"""Appending rows over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column_types: dict[str, str] | None = None,
    batch_size: int = 5_000,
    connections: int = 8,
) -> dict[str, str]:
    """`column_types` are used if the table has to be created; `connections` bounds the load."""
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **(properties or {}),
    }
    if column_types:
        options["createTableColumnTypes"] = ", ".join(
            f"{name} {kind}" for name, kind in column_types.items()
        )
    return options


def append_jdbc(rows: DataFrame, url: str, table: str, **settings) -> None:
    """Append; Spark creates a missing table by itself."""
    rows.write.format("jdbc").options(**jdbc_write_options(url, table, **settings)).mode("append").save()
