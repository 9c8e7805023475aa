"""Near-duplicate detection by SimHash with anchor-point covering.

Fingerprints are 64-bit SimHashes of four-word shingles. Two of them link at four or fewer differing
bits. The 64 bits fall into pieces of 23, 23 and 18 bits; if two fingerprints link, they differ in
at most one bit of the first piece, or in at most one of the second, or in none of the third. The
anchors of a 23-bit piece are the 4096 words of the perfect binary Golay code, a covering
code of radius 3; those of the third piece are all its values (radius 0). Every fingerprint has one
home, the anchor within the covering radius, and visits every anchor within radius plus threshold
(4, or 0), so two linked ones meet at the home of either. Visitors of an anchor are compared with
its residents on all 64 bits, as blocks of a matrix.

Equal fingerprints are one point. An anchor with more than `BLOCK` residents or visitors is cut into
blocks whose pairs are separate groups, so no task holds an unbounded group, and each group
returns a spanning forest of its links instead of all of them. Components are then found by rounds
of large and small stars.

Defined results: a null text counts as empty; a text without words has fingerprint zero and links like any
other; repeated rows are copies of one another; the component of a row is the smallest doc_id
that links reach from it; rows without an id take part and have the component of those they link to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks
from tidemart.llm.columns import named
from tidemart.llm.components import roots
from tidemart.session import checkpointed

WORDS = 4
DISTANCE = 4
SEED = 42
# Residents and visitors of one group.
BLOCK = 4096
# Fixed value: generator polynomial of the binary Golay code of length 23.
_GOLAY = 0b101011100011
# Pieces of a fingerprint: lowest bit, bits, and bits that linked ones may differ in there.
_PIECES = ((0, 23, 1), (23, 23, 1), (46, 18, 0))


def fingerprint(text: str) -> int:
    """SimHash of one text."""
    return int(_fingerprints([text.encode("utf-8", "replace")])[0])


def _fingerprints(texts: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for number, text in enumerate(texts):
        words = text.lower().split()
        if len(words) <= WORDS:
            shingles = [b" ".join(words)] if words else []
        else:
            joined = b" ".join(words)
            ends = np.cumsum([len(word) + 1 for word in words])
            firsts = [0, *ends[: -WORDS].tolist()]
            lasts = (ends[WORDS - 1 :] - 1).tolist()
            shingles = [joined[a:b] for a, b in zip(firsts, lasts, strict=True)]
        counts[number] = len(shingles)
        hashes.extend([xxh64_intdigest(shingle, SEED) for shingle in shingles])
    return _majority(np.array(hashes, np.uint64), counts)


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text the bits that are set in over half of its hashes."""
    result = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    starts = np.cumsum(counts[full]) - counts[full]
    if not len(full):
        return result
    for bit in range(64):
        ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), starts)
        result[full] |= (2 * ones.astype(np.int64) > counts[full]).astype(np.uint64) << np.uint64(bit)
    return result


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a long, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts = [value or b"" for value in batch.column("text").cast(pa.binary()).to_pylist()]
            found = _fingerprints(texts).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return named(docs, "doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where((words >> bit) & 1, _GOLAY << (bit - 11), 0)
    return words


def _leaders() -> np.ndarray:
    """The error of up to three bits that each of the 2048 remainders stands for."""
    single = 1 << np.arange(23)
    double = np.array([a | b for i, a in enumerate(single) for b in single[:i]])
    triple = np.array([a | b for a in double for b in single[single > a]])
    errors = np.concatenate([[0], single, double, triple]).astype(np.int64)
    table = np.zeros(2048, np.int64)
    table[_remainder(errors)] = errors
    return table


def anchors_of(pieces: np.ndarray, bits: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in `pieces`, anchor): all anchors within the covering radius plus `slack`."""
    at = np.arange(len(pieces))
    if bits != 23:
        return at, pieces
    leaders = _leaders()
    near = [pieces] + ([pieces ^ (1 << bit) for bit in range(23)] if slack else [])
    # An anchor within 3 + 1 bits is the home of some word within one bit.
    homes = np.stack([word ^ leaders[_remainder(word)] for word in near], axis=1)
    homes = np.sort(homes, axis=1)
    new = np.c_[np.ones(len(homes), bool), homes[:, 1:] != homes[:, :-1]]
    return np.repeat(at, new.sum(axis=1)), homes[new]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, fp, visits): one as a resident, and one as a visitor of every anchor near."""
    for batch in batches:
        points = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for number, (low, bits, slack) in enumerate(_PIECES):
            piece = ((points >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
            for visits in (False, True):
                at, anchor = anchors_of(piece, bits, slack if visits else 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor * len(_PIECES) + number),
                        pa.array(points[at].view(np.int64)),
                        pa.array(np.full(len(at), visits)),
                    ],
                    ["anchor", "fp", "visits"],
                )


def _forest(residents: np.ndarray, visitors: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what links between residents and visitors connect."""
    points = np.unique(np.concatenate([residents, visitors]))
    label = np.arange(len(points))
    home, guest = np.searchsorted(points, residents), np.searchsorted(points, visitors)
    for start in range(0, len(home), 256):
        rows = home[start : start + 256]
        close = np.bitwise_count(points[rows][:, None] ^ points[guest][None, :]) <= DISTANCE
        for row, linked in zip(rows, close, strict=True):
            parts = label[guest[linked]]
            if len(parts) == 0 or (parts == label[row]).all():
                continue
            parts = np.unique(np.append(parts, label[row]))
            label[np.isin(label, parts)] = parts[0]
    moved = np.flatnonzero(label != np.arange(len(points)))
    return list(zip(points[moved].tolist(), points[label[moved]].tolist(), strict=True))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the groups of a task; rows come sorted by group."""

    def links(rows: pd.DataFrame) -> pa.RecordBatch:
        found: list[tuple[int, int]] = []
        group = rows[["anchor", "i", "j"]].to_numpy()
        ends = np.flatnonzero(np.r_[(group[1:] != group[:-1]).any(axis=1), True]) + 1
        points, visits = rows["fp"].to_numpy().view(np.uint64), rows["visits"].to_numpy()
        start = 0
        for end in ends:
            # Of one point alone there are at most a resident and a visitor.
            if end - start > 2 or (end - start == 2 and points[start] != points[start + 1]):
                guest = visits[start:end]
                own = points[start:end]
                if guest.any() and not guest.all():
                    found.extend(_forest(own[~guest], own[guest]))
            start = end
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    rest: pd.DataFrame | None = None
    for batch in batches:
        rows = batch.to_pandas()
        if rest is not None:
            rows = pd.concat([rest, rows], ignore_index=True)
        if rows.empty:
            continue
        key = rows[["anchor", "i", "j"]].to_numpy()
        # The last group may go on in the next batch.
        cut = np.flatnonzero((key != key[-1]).any(axis=1))
        cut = int(cut[-1]) + 1 if len(cut) else 0
        if cut:
            yield links(rows.iloc[:cut])
        rest = rows.iloc[cut:]
    if rest is not None and len(rest):
        yield links(rest)


def links_between(points: DataFrame) -> DataFrame:
    """Columns a, b: links of distinct fingerprints that connect all that are linked."""
    placed = points.select("fp").mapInArrow(_places, "anchor long, fp long, visits boolean")
    sizes = placed.groupBy("anchor").agg(
        F.ceil(F.count_if(~F.col("visits")) / BLOCK).cast("int").alias("rows"),
        F.ceil(F.count_if("visits") / BLOCK).cast("int").alias("columns"),
    )
    large = sizes.where("rows > 1 OR columns > 1")
    sized = placed.join(large, "anchor", "left")
    draw = F.xxhash64("fp")
    rows, columns = F.greatest("rows", F.lit(1)), F.greatest("columns", F.lit(1))
    # A resident belongs to one row of blocks and goes to each of its columns; a visitor the other way.
    every = lambda n: F.sequence(F.lit(0), n - 1)
    spread = sized.withColumn(
        "block",
        F.explode(
            F.when(
                F.col("visits"),
                F.transform(every(rows), lambda i: F.struct(i.alias("i"), F.pmod(draw, columns).cast("int").alias("j"))),
            ).otherwise(
                F.transform(every(columns), lambda j: F.struct(F.pmod(draw, rows).cast("int").alias("i"), j.alias("j")))
            )
        ),
    ).select("anchor", "block.i", "block.j", "fp", "visits")
    return (
        spread.repartition("anchor", "i", "j")
        .sortWithinPartitions("anchor", "i", "j")
        .mapInArrow(_compare, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    marked = checkpointed(fingerprints(docs))
    points = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    rooted = roots(links_between(points))
    first_of_root = (
        points.join(rooted, F.col("fp") == F.col("node")).groupBy("root").agg(F.min("first").alias("component"))
    )
    linked = rooted.join(first_of_root, "root").select("node", "component")
    # Written, so that the join below is between two plain tables and hot fingerprints can be split.
    classes = checkpointed(
        points.join(linked, F.col("fp") == F.col("node"), "left").select(
            "fp", F.coalesce("component", "first").alias("component_id")
        )
    )
    return marked.join(classes.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id, with all columns.

    Of rows that share an id one stays, that with the smallest text; rows without an id all stay.
    """
    groups = near_duplicates(docs)
    stays = groups.where("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    order = Window.partitionBy("doc_id").orderBy("text")
    one = (
        docs.join(stays.hint("merge"), F.col("doc_id").cast("long") == F.col("_kept_id"), "left_semi")
        .withColumn("_place", F.row_number().over(order))
        .where("_place = 1")
        .drop("_place")
    )
    return one.union(docs.where("doc_id IS NULL"))
