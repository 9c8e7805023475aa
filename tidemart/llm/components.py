"""Connected components of links between long keys, by alternating large and small stars.

Links lead from the larger to the smaller key. A large star hands the larger end of every link on to the
smallest neighbour of its smaller end; a small star hands all smaller neighbours of a node on to the
smallest of them. Rounds end when one leaves the links as they were. Nodes with very many neighbours
are never gathered: minima are added up inside tasks before the shuffle and written, so that the join
back is between two plain tables, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import checkpointed


def _least(links: DataFrame) -> DataFrame:
    """The smallest neighbour of every node that has a smaller one."""
    return checkpointed(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")))


def _large_star(links: DataFrame) -> DataFrame:
    least = _least(links).hint("merge")
    return links.join(least, F.col("b") == F.col("node"), "left").select("a", F.coalesce("m", "b").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = _least(links)
    moved = links.join(least.hint("merge"), F.col("a") == F.col("node")).where("b > m")
    kept = least.select(F.col("node").alias("a"), F.col("m").alias("b"))
    return kept.union(moved.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()


def roots(links: DataFrame) -> DataFrame:
    """node, root of every node with a link; the root is the smallest node of its component.

    `links` has two long columns a, b. Links of a node to itself and repeated links are ignored.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = checkpointed(ordered.distinct())

    def state(frame: DataFrame) -> tuple:
        return tuple(
            frame.agg(
                F.count("*"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
            ).first()
        )

    before = state(current)
    while True:
        current = checkpointed(_small_star(_large_star(current)))
        after = state(current)
        if after == before:
            break
        before = after
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(current.select("b", "b").distinct())
