"""Finding repeated stretches of documents by anchors: what both dedup operators on passages share.

A window is a fixed number of consecutive symbols (bytes or words). The operators choose an anchor for
every window from what stands in the window alone, so equal windows have equal anchors. Consecutive windows
of a document with one anchor form a segment. Segments are told apart by hashes of 96 bits.

1. Tasks collect segments and settle those that repeat within the task; of each repeated one a
   representative goes on. So what a third of all documents share is one row per task afterwards.
2. Segments are dealt by anchor, as compact blocks of bytes. Repeated segments are settled here as wholes;
   segments that differ but share an anchor may still have windows in common and are contested. An operator
   can name two marks of a segment of which any two segments with a common window share one; segments
   that share none with another of their anchor are not contested.
3. The operator settles contested segments from their texts.
4. The settled stretches of every document are put together again with its text.

Texts travel compressed, once, and serve both steps 3 and 4. A verdict is one number: a check value of the
text, flags, the first symbol and the number of symbols.

Verdicts are addressed to (doc_id, twin). Where no two rows share an id, twin is 0. Else it is a hash of 64 bits
of the text, beside the 18 bits of the check value, and rows equal in id and text are one row with a number of
copies until the end: they are added up inside each task before they shuffle, and have the same verdicts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks, flat_bytes
from tidemart.llm.columns import named
from tidemart.llm.words import mixed

# Bytes of text that a task takes apart at once, and segments that it collects before it passes them on.
PARSED = 1 << 20
COLLECTED = 1 << 19
# Bytes of text whose segments one step of a task compares with one another.
PART_BYTES = 16 << 20
# Segments that are compared with one another at once; those of one anchor stay together.
DECIDED = 1 << 17
# Different segments with one anchor from which on their windows are dealt one by one.
HOT = 4096

_SHORT = np.uint64((1 << 48) - 1)
_LENGTH_BITS, _START_BITS = 7, 35
_CONTESTED = 1 << 42
_REFERENCE = 1 << 43
_HOT = 1 << 44
_CHECK_SHIFT = 45

# Rows without an id come before all others. The lowest id of all is not told apart from them.
_NO_ID = -(1 << 63)
# Copies of a row that are put out by one step.
_COPIES = 10_000

VERDICTS = "doc_id long, twin long, verdict long"


@dataclass
class Segments:
    """Segments of a batch of texts. `start` counts symbols of the text, `length` too.

    `left` and `right` are the marks, numbers of 16 or 32 bits; 0 is a mark that none shares.
    """

    anchor: np.ndarray
    content: np.ndarray
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @staticmethod
    def joined(found: list[tuple[np.ndarray, ...]]) -> Segments:
        if not found:
            none = np.zeros(0, np.int64)
            return Segments(none.view(np.uint64), none.view(np.uint64), *[none] * 5)
        return Segments(*(np.concatenate(column) for column in zip(*found, strict=True)))


@dataclass
class Verdicts:
    """Verdict numbers taken apart."""

    start: np.ndarray
    length: np.ndarray
    contested: np.ndarray
    reference: np.ndarray
    hot: np.ndarray


def verdict(check: np.ndarray, start: np.ndarray, length: np.ndarray, flags: np.ndarray | int = 0) -> np.ndarray:
    return (check << _CHECK_SHIFT) | (start << _LENGTH_BITS) | length | flags


def verdicts_of(numbers: np.ndarray, check: int) -> Verdicts:
    """Those for the text with this check value."""
    own = numbers[(numbers >> _CHECK_SHIFT) == check]
    return Verdicts(
        (own >> _LENGTH_BITS) & ((1 << _START_BITS) - 1),
        own & ((1 << _LENGTH_BITS) - 1),
        own & _CONTESTED != 0,
        own & _REFERENCE != 0,
        own & _HOT != 0,
    )


def any_contested(numbers: np.ndarray) -> bool:
    return bool((numbers & _CONTESTED).any())


def checks_of(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A check value of 18 bits of every text."""
    return np.array([crc32(flat[low:high]) >> 14 for low, high in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)


def covered(verdicts: Verdicts, size: int) -> np.ndarray:
    """Which of `size` symbols lie in a settled stretch."""
    settled = ~verdicts.contested
    begins = np.bincount(verdicts.start[settled], minlength=size + 1)
    ends = np.bincount(verdicts.start[settled] + verdicts.length[settled], minlength=size + 1)
    return np.cumsum(begins[:size] - ends[:size]) > 0


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number of the group of every row, rows being sorted by the keys."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _ordered(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Columns of all rows, sorted by anchor, content, document and place."""
    # Anchor, content, document and place.
    keys = [np.concatenate([row[number] for row in rows]) for number in (0, 1, 2, 4)]
    order = np.lexsort(keys[::-1])
    del keys
    # One column after the other, so that no second copy of all is held.
    return tuple(np.concatenate(column)[order] for column in zip(*rows, strict=True))


def _meeting(bucket: np.ndarray, mark: np.ndarray, undecided: np.ndarray) -> np.ndarray:
    """Rows whose mark another row of the bucket has as well, one of the two being undecided."""
    key = (bucket.astype(np.int64) << 32) | mark
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    waiting = np.bincount(place, undecided)[place]
    return (count[place] > 1) & (waiting > 0) & (mark != 0)


def _packed(marks: type, anchor, content, doc, check, start, length, left, right, twin) -> bytes:
    """Rows sorted by document and place, as bytes: hashes of six bytes, then differences, compressed."""
    short = np.stack([anchor, content]).view(np.uint8).reshape(2, -1, 8)[:, :, :6].tobytes()
    sides = np.stack([left, right]).astype(marks).tobytes()
    columns = (
        np.diff(doc, prepend=0), np.diff(start, prepend=0), twin, check.astype(np.int32), length.astype(np.uint8)
    )
    rest = zstandard.ZstdCompressor(level=1).compress(b"".join(column.tobytes() for column in columns))
    return len(anchor).to_bytes(8, "little") + short + sides + rest


def _unpacked(marks: type, blob: pa.Buffer) -> tuple[np.ndarray, ...]:
    blob = memoryview(blob)
    count = int.from_bytes(blob[:8], "little")
    hashes = np.zeros((2, count, 8), np.uint8)
    hashes[:, :, :6] = np.frombuffer(blob, np.uint8, 12 * count, 8).reshape(2, count, 6)
    anchor, content = hashes.view(np.uint64)[:, :, 0]
    sides = 8 + (12 + 2 * np.dtype(marks).itemsize) * count
    left, right = np.frombuffer(blob[8 + 12 * count : sides], marks).reshape(2, count).astype(np.int64)
    rest = zstandard.ZstdDecompressor().decompress(blob[sides:])
    doc = np.cumsum(np.frombuffer(rest, np.int64, count))
    start = np.cumsum(np.frombuffer(rest, np.int64, count, 8 * count))
    twin = np.frombuffer(rest, np.int64, count, 16 * count)
    check = np.frombuffer(rest, np.int32, count, 24 * count).astype(np.int64)
    length = np.frombuffer(rest, np.uint8, count, 28 * count).astype(np.int64)
    return anchor, content, doc, check, start, length, left, right, twin


_DEALT = "part int, blob binary"


def _dealt(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row[0] for row in rows], pa.int32()), pa.array([row[1] for row in rows], pa.binary())],
        ["part", "blob"],
    )


def _collect(
    parse: Callable[[np.ndarray, np.ndarray], Segments], parts: int, smaller_id_only: bool, marks: type
):
    def send(pending: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        anchor, content, doc, check, start, length, left, right, twin = _ordered(pending)
        pending.clear()
        group = _groups(anchor, content)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
        if smaller_id_only:
            done = doc > doc[first][group]
            stays = ~done
        else:
            many = np.diff(np.r_[first, len(group)]) > 1
            done = many[group]
            stays = np.zeros(len(group), bool)
            stays[first] = True
            # The top bit of a length marks a representative of several.
            length = length | (done.astype(np.int64) << _LENGTH_BITS)
        rows = []
        settled = verdict(check[done], start[done], length[done] & 127)
        # They go on by way of some part, just to spread them.
        home = (settled ^ doc[done] ^ twin[done]) % parts
        order = np.argsort(home, kind="stable")
        bounds = np.r_[np.flatnonzero(np.diff(home[order], prepend=-1)), len(order)]
        known = [c[order] for c in (doc[done], twin[done], settled)]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            rows.append((int(home[order[low]]) - parts, np.stack([c[low:high] for c in known]).tobytes()))
        columns = (anchor, content, doc, check, start, length, left, right, twin)
        part = (anchor % np.uint64(parts)).astype(np.int64)
        order = np.flatnonzero(stays)
        order = order[np.lexsort((start[order], doc[order], part[order]))]
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        for number, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if high > low:
                rows.append((number, _packed(marks, *(c[order[low:high]] for c in columns))))
        return _dealt(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, count = [], 0
        for batch in blocks(batches, limit=PARSED):
            flat, offsets = flat_bytes(batch)
            found = parse(flat, offsets)
            ids, twins = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "twin"))
            check = checks_of(flat, offsets)
            pending.append(
                (
                    found.anchor & _SHORT, found.content & _SHORT, ids[found.text], check[found.text],
                    found.start, found.length, found.left, found.right, twins[found.text],
                )
            )
            count += len(found.anchor)
            if count >= COLLECTED:
                yield send(pending)
                pending, count = [], 0
        if count:
            yield send(pending)

    return run


def settled_rows(docs, twins, verdicts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in (docs, twins, verdicts)], ["doc_id", "twin", "verdict"]
    )


def _settle(smaller_id_only: bool, marks: type):
    def decide(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        anchor, content, doc, check, start, length, left, right, twin = _ordered(rows)
        group, bucket = _groups(anchor, content), _groups(anchor)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size, several = length & 127, length >> _LENGTH_BITS
        if smaller_id_only:
            done = doc > doc[first][group]
            stays, undecided = ~done, np.ones(len(first), bool)
            reference = np.zeros(len(doc), np.int64)
        else:
            count = np.bincount(group, 1 + several)
            done = (count[group] > 1) & (several == 0)
            stays = np.zeros(len(doc), bool)
            stays[first] = True
            undecided = count == 1
            reference = np.where(undecided[group], 0, _REFERENCE)
        # Segments of an anchor that share a mark with another one.
        meets = _meeting(bucket[first], left[first], undecided) | _meeting(bucket[first], right[first], undecided)
        open_ = stays & meets[group]
        kinds = np.bincount(bucket[first][meets], minlength=bucket[-1] + 1)[bucket]
        hot = np.where(kinds >= HOT, _HOT, 0)
        settled = verdict(check[done], start[done], size[done])
        contested = verdict(check, start, size, _CONTESTED | hot | reference)[open_]
        return settled_rows(np.r_[doc[done], doc[open_]], np.r_[twin[done], twin[open_]], np.r_[settled, contested])

    def pieces(blobs: list[pa.Buffer]) -> Iterator[list[tuple[np.ndarray, ...]]]:
        rows = [_unpacked(marks, blob) for blob in blobs]
        count = -(-sum(len(row[0]) for row in rows) // DECIDED)
        places = [mixed(row[0]) % np.uint64(count) for row in rows]
        for number in range(count):
            piece = [tuple(column[place == number] for column in row) for row, place in zip(rows, places, strict=True)]
            if any(len(row[0]) for row in piece):
                yield piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[pa.Buffer]] = {}
        for batch in batches:
            for number, blob in zip(batch.column("part").to_pylist(), batch.column("blob"), strict=True):
                if number < 0:
                    yield settled_rows(*np.frombuffer(blob.as_py(), np.int64).reshape(3, -1))
                else:
                    blobs.setdefault(number, []).append(blob.as_buffer())
        for part in blobs.values():
            yield from map(decide, pieces(part))

    return run


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in blocks(batches, limit=PARSED):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in ("doc_id", "twin", "copies")),
                pa.array([pack.compress(text) for text in texts], pa.binary()),
            ],
            ["doc_id", "twin", "copies", "zipped"],
        )


def unzipped(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


@dataclass
class Judged:
    """Different texts (doc_id, twin, copies, zipped) and the list of verdicts of each that has any."""

    texts: DataFrame
    verdicts: DataFrame
    shared: bool

    def joined(self, more: DataFrame | None = None) -> DataFrame:
        """doc_id, twin, copies, zipped, verdicts and, if given, the column `resolved` of more verdicts."""
        rows = self.texts.join(self.verdicts.hint("merge"), ["doc_id", "twin"], "left")
        return rows if more is None else rows.join(more.hint("merge"), ["doc_id", "twin"], "left")

    def given(self, found: DataFrame) -> DataFrame:
        """One row for each of the `copies` of a found row, with the ids as they were given."""
        if self.shared:
            steps = found.withColumn("_step", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(_COPIES))))
            some = F.least(F.col("copies") - F.col("_step"), F.lit(_COPIES))
            spread = steps.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            each = F.explode(F.array_repeat(F.lit(True), some.cast("int")))
            found = spread.withColumn("_copy", each).drop("_step", "_copy")
        return found.drop("copies").withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


def lists(verdicts: DataFrame, name: str) -> DataFrame:
    """The verdicts (doc_id, twin, verdict) of each text; twice as many as it has segments at most."""
    return verdicts.groupBy("doc_id", "twin").agg(F.collect_list("verdict").alias(name))


def judge(
    docs: DataFrame,
    parse: Callable[[np.ndarray, np.ndarray], Segments],
    smaller_id_only: bool,
    marks: type = np.uint16,
) -> Judged:
    """Settle segments. A segment repeats if it also stands elsewhere, or else in a smaller id's text.

    `marks` is the type of the numbers that segments are marked with.

    Rows without an id count as having the lowest id of all.
    """
    slim = named(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    by_id = slim.groupBy("doc_id").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text").cast("long")).alias("size"))
    size, shared = by_id.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("rows"), F.lit(0)) > 1).first()
    if shared:
        slim = slim.groupBy("doc_id", "text").agg(F.count("*").alias("copies")).withColumn("twin", F.xxhash64("text"))
    else:
        slim = slim.withColumns({"copies": F.lit(1).cast("long"), "twin": F.lit(0).cast("long")})
    parsed = slim
    if shared and not smaller_id_only:
        # Copies repeat one another; two of them show it.
        two = F.array_repeat(F.lit(True), F.least("copies", F.lit(2)).cast("int"))
        parsed = slim.withColumn("_copy", F.explode(two)).drop("_copy")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    dealt = parsed.mapInArrow(_collect(parse, parts, smaller_id_only, marks), _DEALT)
    # Each task gets one part: dealt by a hash, some would get several at once.
    by_part = dealt.repartitionById(parts, F.pmod("part", F.lit(parts)))
    settled = by_part.mapInArrow(_settle(smaller_id_only, marks), VERDICTS)
    texts = slim.mapInArrow(_zipped, "doc_id long, twin long, copies long, zipped binary").repartition("doc_id", "twin")
    return Judged(texts, lists(settled, "verdicts"), shared)
