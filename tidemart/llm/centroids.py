"""Sums over all subtrees of a forest by centroid decomposition.

A component is a connected piece of the forest, at first a whole tree. Its centroid is the lowest node whose
subtree weighs more than half of it. Taking the centroid out splits the component: into one below each of
its children and the rest above, none heavier than half. What the centroid and the components below it add up to
belongs to the centroid and to every node on the path from it to the top of its component, and to no other node
above; so a level adds these totals along the paths, and the components left are taken up by the next one.
Depth does not matter: a chain of n nodes takes as many levels as a bush of n nodes, log2 of the weight.

Nodes come with weights whose sums over subtrees are known: the conversations that pass a node, added up over
its subtree (see `conversations`). Their being known is what makes a centroid one aggregate, and the path above
it a comparison: its nodes are those that weigh more than half. Which nodes lie below a centroid is told by
the sequences themselves: a node is represented by a sequence that passes it, and lies below the
centroid if that sequence passes a child of the centroid further up.

Components above `ROLLED` are split by Spark, all at the same time, one level a round. Lighter ones have no more
nodes than their weight; tasks split them the rest of the way, many at once, by the same steps on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.session import scratch_dir

# The weight up to which a component goes to one task.
ROLLED = 256
# Nodes that a task works on at once, about.
TOGETHER = 1 << 15


def tops_of(up: np.ndarray) -> np.ndarray:
    """The top of each node's component; `up` has the parent, and of a top the node itself."""
    while True:
        further = up[up]
        if (further == up).all():
            return up
        up = further


def subtree_sums(up: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of each row of `values` over the subtree of every node.

    `up` has the parent of each node, and of tops the node itself; `weight` the sum of the weights of its subtree.
    """
    count = len(up)
    up, weight, live = up.copy(), weight.copy(), np.ones(count, bool)
    own, sums = np.arange(count), np.zeros_like(values)
    while live.any():
        top = tops_of(up)
        on_path = live & (2 * weight > weight[top])
        path = np.flatnonzero(on_path)
        path = path[np.lexsort((weight[path], top[path]))]
        lowest = path[np.r_[True, top[path][1:] != top[path][:-1]]]
        centroid = np.full(count, -1)
        centroid[top[lowest]] = lowest
        centroid = np.where(live, centroid[top], -1)
        is_centroid = centroid == own
        # Children of a centroid become tops, the centroid stands alone.
        cut = np.where(is_centroid | (live & is_centroid[up]), own, up)
        piece = tops_of(cut)
        below = live & ~is_centroid & (piece != top) & (up[piece] == centroid)
        totals = np.zeros_like(values)
        inside = np.flatnonzero(below | is_centroid)
        for total, value in zip(totals, values, strict=True):
            np.add.at(total, centroid[inside], value[inside])
        above = np.flatnonzero(on_path & ~is_centroid)
        for some in (above, np.flatnonzero(is_centroid)):
            sums[:, some] += totals[:, centroid[some]]
        weight[above] -= weight[centroid[above]]
        live &= ~is_centroid
        up = cut
    return sums


def _rolled(batches: Iterator[pa.RecordBatch], values: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Sums of whole components, whose rows come one after another."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < TOGETHER:
            continue
        # The last component may go on in the next batch.
        components = held.column("component").to_pylist()
        end = len(components)
        while end and components[end - 1] == components[-1]:
            end -= 1
        if end:
            yield from _sums_of(held.slice(0, end), values)
            held = held.slice(end)
    if held is not None and held.num_rows:
        yield from _sums_of(held, values)


def _sums_of(rows: pa.Table, values: Sequence[str]) -> Iterator[pa.RecordBatch]:
    nodes, parents, components = (rows.column(name).to_pylist() for name in ("node", "parent", "component"))
    place = {node: i for i, node in enumerate(nodes)}
    up = np.arange(len(nodes))
    for i, parent in enumerate(parents):
        at = place.get(parent, i)
        if components[at] == components[i]:
            up[i] = at
    weight = rows.column("weight").to_numpy()
    sums = subtree_sums(up, weight, np.stack([rows.column(name).to_numpy() for name in values]))
    added = [pa.array(total + rows.column(f"sum_{name}").to_numpy()) for name, total in zip(values, sums, strict=True)]
    yield pa.RecordBatch.from_arrays([rows.column("node").combine_chunks(), *added], ["node", *values])


def _written(frame: DataFrame) -> DataFrame:
    """A table in the shared folder; its size tells Spark whether to broadcast it.

    Unlike a checkpoint it carries no constraints, which would multiply from round to round.
    """
    path = scratch_dir(frame.sparkSession, "centroids")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _added(values: Sequence[str], add: Column, total: str) -> dict[str, Column]:
    zero = F.lit(0).cast("long")
    return {f"sum_{name}": F.col(f"sum_{name}") + F.when(add, F.col(f"{total}{name}")).otherwise(zero) for name in values}


def roll_up(passages: DataFrame, nodes: DataFrame, values: Sequence[str], rolled: int = ROLLED) -> DataFrame:
    """node, and the sum of each of `values` (longs) over its subtree.

    `passages` has (seq, depth, node, parent) for every node that a sequence passes, from its top on. `nodes` has
    (node, parent, seq, depth, weight) and the values: `seq` is one of the sequences that pass it, such that
    (seq, depth) is in `passages`. The parent of a top is NULL.
    """
    zero = F.lit(0).cast("long")
    own = nodes.select("seq", "depth", "weight", *values, *[zero.alias(f"sum_{name}") for name in values])
    # Passages that do not represent their node have no weight; they only tell what lies below what.
    live = passages.join(own, ["seq", "depth"], "left")
    first = passages.where(F.col("parent").isNull()).select("seq", F.col("node").alias("component"))
    live = _written(live.join(first, "seq"))
    columns = live.columns
    is_own = F.col("weight").isNotNull()
    on_path = is_own & (2 * F.col("weight") > F.col("total"))
    light, done = [], []
    while True:
        totals = _written(live.where(is_own).groupBy("component").agg(F.max("weight").alias("total")))
        live = live.join(totals, "component")
        light.append(live.where(is_own & (F.col("total") <= rolled)).drop("total", "seq", "depth"))
        live = live.where(F.col("total") > rolled)
        if totals.where(F.col("total") > rolled).isEmpty():
            break
        centre = F.min_by(F.struct(F.col("node").alias("c_node"), F.col("depth").alias("c_depth"), F.col("weight").alias("c_weight")), "weight")
        centroids = _written(live.where(on_path).groupBy("component").agg(centre.alias("c")).select("component", "c.*"))
        live = live.join(centroids, "component")
        below = live.where((F.col("parent") == F.col("c_node")) & (F.col("depth") == F.col("c_depth") + 1))
        below = below.select("seq", "component", F.col("node").alias("piece"))
        is_below = F.col("piece").isNotNull() & (F.col("depth") > F.col("c_depth"))
        split = live.join(below, ["seq", "component"], "left").withColumn("_below", is_below)
        split = split.withColumn("_centroid", F.col("node") == F.col("c_node"))
        split = _written(split.withColumn("_above", on_path & ~F.col("_below") & ~F.col("_centroid")).drop("total"))
        inside = split.where(is_own & (F.col("_below") | F.col("_centroid")))
        added = _written(inside.groupBy("component").agg(*[F.sum(name).alias(f"of_{name}") for name in values]))
        split = split.join(added, "component").withColumns(_added(values, F.col("_above") | F.col("_centroid"), "of_"))
        done.append(split.where(F.col("_centroid") & is_own).select("node", *[F.col(f"sum_{name}").alias(name) for name in values]))
        weight = F.when(F.col("_above"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight"))
        component = F.when(F.col("_below"), F.col("piece")).otherwise(F.col("component"))
        left = split.where(~F.col("_centroid")).withColumns({"weight": weight, "component": component})
        live = left.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rolled(batches, values)

    rest = reduce(DataFrame.unionByName, light).repartition("component").sortWithinPartitions("component")
    schema = ", ".join([f"node {dict(nodes.dtypes)['node']}", *[f"{name} long" for name in values]])
    return reduce(DataFrame.unionByName, [rest.mapInArrow(run, schema), *done])
