"""Hard negatives: rows of another label that score nearly as high with an anchor as its positives do.

Scores are integer inner products. Every query anchor meets all rows, in blocks: a round takes anchors of at
most `ANCHOR_BYTES` of components, which is what it broadcasts, and tasks score them against `ROWS` rows at a
time with one matrix product. Pairs of anchor and row travel as keys packed of (anchor, descending
score, id) through `repartitionAndSortWithinPartitions`, so that a task reads the pairs of an anchor from the
highest score down and none has to hold an anchor. Two such shuffles make a round:

1. positives: a block of rows keeps its first `POSITIVES` rows of the anchor's label, the stream takes the first
   `POSITIVES` of all blocks; the score of each opens a window of scores for its negatives.
2. negatives: a block keeps, for each window, its first `NEGATIVES` rows of other labels in it; the stream reads
   them together with the positives, opens a window when it meets a positive, and writes the rows that fall
   into open windows until each has had `NEGATIVES`.

What a block leaves out is behind enough other rows of the same block in every window, so nothing is lost, and no
more than `POSITIVES` * (1 + `NEGATIVES`) pairs of an anchor and a block are shuffled, ties and copies included.

Defined results: rows without an id, a label or a vector, or with a null or non-finite component, take no part;
of rows that share an id the least (label, vector) counts, so repeated rows count once; shorter vectors are
filled up with zeros; equal scores are ordered by id; anchors without positives, or positives without
negatives, have no rows; an empty table gives none. Components beyond 63 bits and scores beyond 62 count as
the largest such number of their sign. Only vec_id, embedding and label are read, so other columns cannot clash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import checkpointed

QUERY_STEP = 50
POSITIVES = 5
NEGATIVES = 3
ANCHOR_BYTES = 4 << 20
ROWS = 16_384
# Anchors whose scores with a block of rows are held at once.
SCORED = 128

_LIMIT = 1 << 62
_EXACT = 1 << 53
_KEY = struct.Struct(">QQQ")
_SIGN = 1 << 63

RESULT = T.StructType(
    [
        T.StructField("anchor_id", T.LongType()),
        T.StructField("positive_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("negative_id", T.LongType()),
        T.StructField("positive_score", T.LongType()),
        T.StructField("negative_score", T.LongType()),
    ]
)


def pack(anchor: int, score: int, row: int) -> bytes:
    """A key that sorts by anchor, descending score, id."""
    return _KEY.pack(anchor + _SIGN, _SIGN - score, row + _SIGN)


def unpack(key: bytes) -> tuple[int, int, int]:
    anchor, score, row = _KEY.unpack(key)
    return anchor - _SIGN, _SIGN - score, row - _SIGN


def window_of(score: int) -> tuple[int, int]:
    """Least and largest score of a negative for a positive of this score."""
    return -(-50 * score // 100), 95 * score // 100


def usable(rows: DataFrame, relabel: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label and whole components of the rows that take part, one for each id."""
    known = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = known.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    least = known.where(finite).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("least"))
    label = F.col("least.label")
    label = F.when(F.col("vec_id") % relabel == 0, (label + 1) % labels).otherwise(label)
    whole = F.transform("least.embedding", lambda x: F.floor(x * 256).cast("double"))
    return least.select("vec_id", label.alias("label"), whole.alias("x"))


@dataclass
class Vectors:
    """Rows in the order of their ids."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Vectors:
        rows = rows.combine_chunks()
        ids, labels = (rows.column(name).to_numpy() for name in ("vec_id", "label"))
        order = np.argsort(ids, kind="stable")
        lists = pa.concat_arrays(rows.column("x").chunks) if len(ids) else pa.array([], pa.list_(pa.float64()))
        sizes = pc.list_value_length(lists).to_numpy()
        x = np.zeros((len(ids), int(sizes.max(initial=0))))
        x[np.arange(x.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        return cls(ids[order], labels[order], x[order])

    def cut(self, start: int, stop: int) -> Vectors:
        return Vectors(self.ids[start:stop], self.labels[start:stop], self.x[start:stop])


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers as 64-bit integers."""
    size = min(anchors.shape[1], rows.shape[1])
    if not size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    anchors, rows = anchors[:, :size], rows[:, :size]
    if size * np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) < _EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = [np.array([[int(value) for value in row] for row in side], object) for side in (anchors, rows)]
    return np.clip(whole[0] @ whole[1].T, -_LIMIT, _LIMIT).astype(np.int64)


def first_of(found: np.ndarray, mine: np.ndarray, count: int) -> np.ndarray:
    """Places of the first `count` of `mine` by descending score, then place; fewer if there are not as many."""
    places = np.flatnonzero(mine)
    if len(places) > count:
        values = found[places]
        least = np.partition(values, len(values) - count)[len(values) - count]
        above = places[values > least]
        places = np.r_[above, places[values == least][: count - len(above)]]
    return places


def _pairs(anchors: Vectors, batches: Iterator[pa.RecordBatch], chosen) -> Iterator[pa.RecordBatch]:
    """Packed keys of the pairs that `chosen` keeps of each anchor and block of rows."""
    for rows in blocks_of(batches):
        keys, positive = [], []
        for start in range(0, len(anchors.ids), SCORED):
            own = anchors.cut(start, start + SCORED)
            found = scores(own.x, rows.x)
            for at, (anchor, label) in enumerate(zip(own.ids.tolist(), own.labels.tolist(), strict=True)):
                same = rows.labels == label
                for places, kind in chosen(anchor, found[at], same, rows.ids):
                    values, ids = found[at][places].tolist(), rows.ids[places].tolist()
                    keys += [pack(anchor, value, row) for value, row in zip(values, ids, strict=True)]
                    positive += [kind] * len(ids)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(positive, pa.bool_())], ["key", "positive"])


def blocks_of(batches: Iterator[pa.RecordBatch], size: int = ROWS) -> Iterator[Vectors]:
    """Batches put together to blocks of about `size` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= size:
            yield Vectors.of(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield Vectors.of(pa.Table.from_batches(held))


def first_positives(anchor: int, found: np.ndarray, same: np.ndarray, ids: np.ndarray):
    yield first_of(found, same & (ids != anchor), POSITIVES), True


def _negatives_in(windows: dict[int, list[tuple[int, int]]]):
    """`windows` has (id, score) of the positives of each anchor."""

    def chosen(anchor: int, found: np.ndarray, same: np.ndarray, ids: np.ndarray):
        open_ones = windows.get(anchor, [])
        kept = []
        for score in {score for _, score in open_ones}:
            low, high = window_of(score)
            if low <= high:
                kept.append(first_of(found, ~same & (found >= low) & (found <= high), NEGATIVES))
        if kept:
            yield np.unique(np.concatenate(kept)), False
        wanted = np.array([row for row, _ in open_ones], np.int64)
        yield np.flatnonzero(np.isin(ids, wanted)), True

    return chosen


def sorted_pairs(pairs: DataFrame, tasks: int) -> RDD:
    """Pairs dealt by anchor, each task reading them in the order of their keys."""
    keyed = pairs.rdd.map(lambda row: (bytes(row.key), row.positive))
    return keyed.repartitionAndSortWithinPartitions(tasks, lambda key: int.from_bytes(key[:8], "big") // QUERY_STEP)


def stream_positives(pairs: Iterator[tuple[bytes, bool]]) -> Iterator[tuple[int, int, int]]:
    """(anchor, id, score) of the first positives of each anchor."""
    current, count = None, 0
    for key, _ in pairs:
        anchor, score, row = unpack(key)
        if anchor != current:
            current, count = anchor, 0
        if count < POSITIVES:
            count += 1
            yield anchor, row, score


def stream_negatives(pairs: Iterator[tuple[bytes, bool]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of the result. Held are the open windows of one anchor and the first negatives of one score."""
    current, opened, level, passed = None, [], None, []
    for key, positive in pairs:
        anchor, score, row = unpack(key)
        if anchor != current:
            current, opened, level = anchor, [], None
        if score != level:
            level, passed = score, []
            opened = [one for one in opened if one[2] <= score and one[4] < NEGATIVES]
        if positive:
            low, high = window_of(score)
            opened.append(one := [row, score, low, high, 0])
            # Only a score of 0 lies in its own window; negatives of that score may have come before.
            meeting = [(one, negative) for negative in passed] if low <= score <= high else []
        else:
            passed = [*passed, row][:NEGATIVES]
            meeting = [(one, row) for one in opened if one[3] >= score and one[4] < NEGATIVES]
        for one, negative in meeting:
            one[4] += 1
            yield anchor, one[0], one[4], negative, one[1], score


def _mine_block(spark: SparkSession, rows: DataFrame, anchors: Vectors, tasks: int) -> DataFrame:
    schema = "key binary, positive boolean"
    shared = spark.sparkContext.broadcast(anchors)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pairs(shared.value, batches, first_positives)

    firsts = sorted_pairs(rows.mapInArrow(best, schema), tasks).mapPartitions(stream_positives)
    windows: dict[int, list[tuple[int, int]]] = {}
    # As many as there are anchors in a block, times POSITIVES.
    for anchor, row, score in firsts.collect():
        windows.setdefault(anchor, []).append((row, score))
    opened = spark.sparkContext.broadcast(windows)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pairs(shared.value, batches, _negatives_in(opened.value))

    return sorted_pairs(rows.mapInArrow(near, schema), tasks).mapPartitions(stream_negatives).toDF(RESULT)


def mine(rows: DataFrame, query_step: int = QUERY_STEP, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Hard negatives of all rows whose id is divisible by `query_step`."""
    spark = rows.sparkSession
    known = checkpointed(usable(rows))
    queries = known.where(F.col("vec_id") % query_step == 0)
    count, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    blocks = max(1, -(-count * max(size, 1) * 8 // anchor_bytes))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Blocks of hashed ids are of about the same size.
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    found = []
    for number in range(blocks):
        anchors = Vectors.of(queries.where(block == number).toArrow())
        if len(anchors.ids):
            found.append(checkpointed(_mine_block(spark, known, anchors, tasks)))
    if not found:
        return spark.createDataFrame([], RESULT)
    result = found[0]
    for frame in found[1:]:
        result = result.unionByName(frame)
    return result


NEGATIVES_SQL = """
WITH least AS (
    SELECT vec_id, min({'label': label, 'embedding': embedding}) AS kept
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
),
known AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (kept.label + 1) % 10 ELSE kept.label END AS label,
           list_transform(kept.embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
    FROM least
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS row_id, a.label = b.label AS same,
           CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM known a JOIN known b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, row_id) AS INTEGER) AS rank,
       row_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
