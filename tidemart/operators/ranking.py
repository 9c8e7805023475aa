"""Exact ranks and running numbers that no task holds a whole group for.

Rows are dealt by sampled ranges of (group, order), so a group of any size is cut into pieces that follow
one another. Each piece is numbered by itself; what the pieces before it hold is added. Only the first group
of a piece can have begun in an earlier one, so there are fewer such additions than pieces.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.session import checkpointed

# Rows that agree in all columns of the order are cut into this many ranges at most.
TIES = 1024

_PIECE = "_piece"
_TIE = "_tie"
_BEFORE = "_before"


def ranked(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    rank: str = "rank",
    pieces: int | None = None,
) -> DataFrame:
    """Add the place of each row in its group, from 1, without gaps or ties.

    `order` has columns, or sort expressions. Without `group` all rows are one group. Rows that agree in all
    of them come in any order. `pieces` is the number of ranges; by default that of shuffle partitions.
    """
    tie = F.pmod(F.monotonically_increasing_id(), F.lit(TIES))
    keys = [*[F.col(name) for name in group], *[F.col(key) if isinstance(key, str) else key for key in order]]
    counted = [] if pieces is None else [pieces]
    dealt = rows.withColumn(_TIE, tie).repartitionByRange(*counted, *keys, F.col(_TIE))
    # Written, as ranges may be sampled differently when they are computed again.
    dealt = checkpointed(dealt.withColumn(_PIECE, F.spark_partition_id()))
    sizes = dealt.groupBy(_PIECE, *group).agg(F.count(F.lit(1)).alias("_size"))
    # One row for each piece a group lies in.
    earlier = W.partitionBy(*group or [F.lit(0)]).orderBy(_PIECE).rowsBetween(W.unboundedPreceding, -1)
    names = [_PIECE, *group]
    before = (
        sizes.withColumn(_BEFORE, F.sum("_size").over(earlier))
        .where(F.col(_BEFORE) > 0)
        .select(_BEFORE, *[F.col(name).alias(f"_of_{name}") for name in names])
    )
    place = F.row_number().over(W.partitionBy(_PIECE, *group).orderBy(*keys[len(group) :], _TIE))
    # NULL is a group like any other.
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in names])
    # Fewer rows than pieces.
    joined = dealt.withColumn(rank, place).join(F.broadcast(before), same, "left")
    number = F.col(rank) + F.coalesce(F.col(_BEFORE), F.lit(0).cast("long"))
    return joined.select(*rows.columns, number.alias(rank))
