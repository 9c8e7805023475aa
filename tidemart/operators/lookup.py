"""Looking facts up in a dimension whose size is measured first.

A dimension that fits is broadcast, so the facts are not shuffled at all. A larger one is
joined by shuffling both sides; adaptive execution splits hot keys there. Where adaptive
execution cannot be relied on, `salts` shares hot keys, which are measured, among several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The most data, as measured by `payload_bytes`, that may be sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

_ROW_OVERHEAD = 64
# Nested values are measured by their JSON text; a number of one digit and its comma take eight bytes.
_NESTED_FACTOR = 4
_SALT = "_salt"


def payload_bytes(rows: DataFrame) -> int:
    """Bytes the rows take up in a broadcast hash table, counted in one distributed pass."""
    size = F.lit(_ROW_OVERHEAD).cast("long")
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(column.alias("v")))
            size = size + F.octet_length(text).cast("long") * _NESTED_FACTOR
        elif isinstance(field.dataType, T.VariantType):
            size = size + F.coalesce(F.octet_length(column.cast("string")).cast("long"), F.lit(0)) * _NESTED_FACTOR
        else:
            size = size + F.lit(16)
    return rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(rows: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return limit > 0 and payload_bytes(rows) <= limit


def hot_keys(facts: DataFrame, key: str, tasks: int) -> dict:
    """Keys with more than one in `tasks` of all facts, and how many tasks each should take.

    There are fewer than `tasks` of them, whatever the data.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).count()
    fair = facts.count() / tasks
    largest = counts.where(F.col("count") > fair).collect()
    return {row[key]: -(-row["count"] // max(1, int(fair))) for row in largest}


def salted_join(facts: DataFrame, dimension: DataFrame, key: str, how: str, tasks: int) -> DataFrame:
    """Equi join on `key` in which no task gets much more than one in `tasks` of the facts.

    Hot keys are shared among as many salts as their share asks for, all others keep one. The
    salt of a fact is the number of the task that read it: the same whenever that task is repeated, and
    different for equal rows read by different tasks. Every salt of a key finds a copy of
    its rows of the dimension, so the result is that of the plain join.
    """
    hot = hot_keys(facts, key, tasks)
    kind = facts.schema[key].dataType

    def salts(column: Column) -> Column:
        count = F.lit(1)
        for value, number in hot.items():
            count = F.when(column == F.lit(value).cast(kind), number).otherwise(count)
        return count

    marked = facts.withColumn(_SALT, F.spark_partition_id() % salts(F.col(key)))
    copies = dimension.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts(F.col(key)) - 1)))
    return marked.join(copies.hint("merge"), [key, _SALT], how).drop(_SALT)


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "left",
    broadcast_limit: int | None = BROADCAST_BYTES,
    salts: int = 1,
) -> DataFrame:
    """Join `dimension` to `facts` on the column `key` that both have.

    A key that occurs several times in the dimension multiplies its facts, and a NULL key
    matches nothing. Without a limit Spark decides by its own statistics, in a stream anew for
    every micro-batch.
    """
    if broadcast_limit is None:
        return facts.join(dimension, key, how)
    if fits_broadcast(dimension, broadcast_limit):
        return facts.join(F.broadcast(dimension), key, how)
    if salts > 1 and not facts.isStreaming:
        return salted_join(facts, dimension, key, how, salts)
    return facts.join(dimension.hint("merge"), key, how)
