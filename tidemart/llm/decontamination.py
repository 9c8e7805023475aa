"""Benchmark decontamination by spaced-seed hashing.

Words are runs of letters and digits, A to Z in lower case; of scripts written without blanks (`UNSPACED`)
each character is a word. A document has leaked an item if, with both laid side by side at some
offset, a stretch of 15 words (all words of an item that has fewer) agrees in four fifths of them or more.

Masks look at some words of a stretch and ignore the others, so substituted words at the ignored places
do not hide a match. For items of 13 words or more, three fixed masks of six words are laid at every
position. Of 13 or more words with as many substituted as four fifths allow, one of the masks stays
unbroken. Each length of 2 to 12 words has masks of its own (`FAMILIES`), laid at fixed places of the
item: its words fall into groups, and a mask leaves out as many groups as words may be
substituted. So nothing is missed. Documents are hashed under those masks only that an item needs.

Hashes of the documents first pass a bit field of fixed size that holds the item hashes (two
bits each); what passes is joined with the item hashes by a shuffle, so a benchmark of any size works.
Documents keep just the words around the places that passed; each pair of item and offset is
verified there once.

Defined results: null and empty texts have no words; an item of one word is not searched for; a document
appears once for each item_id, with its best stretch, the first one in a tie; different texts under one
item_id are all searched for; items without an id are too, each different text gives a row of its own
with a null item_id; repeated rows that share an id appear once; documents without an id are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks, flat_bytes
from tidemart.llm.columns import named
from tidemart.llm.words import PUNCTUATION, lowered, mixed, split_words, word_hashes
from tidemart.session import checkpointed

STRETCH = 15
SIMILARITY = 0.8
# The places that each mask of long items looks at, and the words of the shortest of these.
_SLIDING = ((0, 1, 3, 4, 5, 6), (0, 1, 2, 6, 9, 10), (0, 4, 5, 7, 9, 10))
_LONG = 13


def _family(length: int) -> list[tuple[int, ...]]:
    """Places of an item of so many words that each of its masks looks at."""
    substituted = length // 5
    # Few groups give few masks, many give masks of more words; none looks at fewer than four of five or more.
    groups = np.array_split(np.arange(length), {0: 1, 1: 5 if length == 5 else 3, 2: 4}[substituted])
    return [
        tuple(int(place) for group in kept for place in group)
        for kept in combinations(groups, len(groups) - substituted)
    ]


FAMILIES = {length: _family(length) for length in range(2, _LONG)}
# All masks from their first place on.
MASKS = _SLIDING + tuple(
    sorted({tuple(p - places[0] for p in places) for family in FAMILIES.values() for places in family} - set(_SLIDING))
)
# First and last code points of scripts that leave no blanks between words, and of signs that part words there.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3021, 0x302F), (0x3031, 0x3035),
    (0x3038, 0x303C), (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
)
_PARTING = ((0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x303D, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F),
            (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_FIELD_BITS = 24
# Words kept on either side of a seed.
_AROUND = STRETCH


def _within(code: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    found = np.zeros(len(code), bool)
    for first, last in ranges:
        found |= (code >= first) & (code <= last)
    return found


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch, and the offsets of the texts among them."""
    flat, offsets = flat_bytes(batch)
    flat = lowered(flat)
    breaks = []
    # Only characters of three and four bytes can be of these scripts.
    for size, lead in ((3, (flat >= 0xE0) & (flat < 0xF0)), (4, flat >= 0xF0)):
        at = np.flatnonzero(lead)
        at = at[at + size <= len(flat)]
        code = flat[at].astype(np.int64) & (0x0F if size == 3 else 0x07)
        for byte in range(1, size):
            code = code << 6 | (flat[at + byte] & 0x3F)
        parting = _within(code, _PARTING)
        own = at[_within(code, UNSPACED) & ~parting]
        breaks += [own, own + size]
        for byte in range(size):
            flat[at[parting] + byte] = 0x20
    starts, ends, texts = split_words(flat, offsets, PUNCTUATION, np.concatenate(breaks))
    return word_hashes(flat, starts, ends), texts


def _seeds(words: np.ndarray, texts: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a mask fits into its text, and the hashes of the words it looks at."""
    places = MASKS[mask]
    room = np.repeat(texts[1:], np.diff(texts)) - np.arange(texts[0], texts[-1])
    at = np.flatnonzero(room > places[-1])
    return at, _hashed(words, at, mask)


def _hashed(words: np.ndarray, at: np.ndarray, mask: int) -> np.ndarray:
    value = np.full(len(at), mask + 1, np.uint64)
    for place in MASKS[mask]:
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[at + place]
        value ^= value >> np.uint64(29)
    return mixed(value)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = {places: mask for mask, places in enumerate(MASKS)}
    for batch in blocks(batches):
        words, texts = _words(batch)
        sizes = np.diff(texts)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        items = batch.column("item_key").to_numpy(zero_copy_only=False)
        found = []
        for mask in range(len(_SLIDING)):
            at, value = _seeds(words, texts, mask)
            long = sizes[owner[at]] >= _LONG
            found.append((mask, at[long], value[long]))
        for length, family in FAMILIES.items():
            first = texts[:-1][sizes == length]
            for places in family:
                mask = number[tuple(place - places[0] for place in places)]
                found.append((mask, first + places[0], _hashed(words, first + places[0], mask)))
        for mask, at, value in found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(items[owner[at]].astype(np.int64)),
                    pa.array((at - texts[owner[at]]).astype(np.int32)),
                    pa.array(value.view(np.int64)),
                    pa.array(np.full(len(at), mask, np.int32)),
                ],
                ["item_key", "item_at", "seed", "mask"],
            )


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        words, texts = _words(batch)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_key"),
                batch.column("item_id"),
                pa.ListArray.from_arrays(texts.astype(np.int32), words.view(np.int64)),
            ],
            ["item_key", "item_id", "item_words"],
        )


def _bits(seed: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << width) - 1)
    return (seed & low).astype(np.int64), ((seed >> np.uint64(width)) & low).astype(np.int64)


def bit_field(seeds: DataFrame) -> np.ndarray:
    """The bits of all item hashes; at most 2^18 rows of 64 bits come to the driver, whatever the items."""
    low = (1 << _FIELD_BITS) - 1
    bit = F.explode(
        F.array(
            F.col("seed").bitwiseAND(F.lit(low)),
            F.shiftrightunsigned("seed", _FIELD_BITS).bitwiseAND(F.lit(low)),
        )
    )
    rows = (
        seeds.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
        .collect()
    )
    field = np.zeros(1 << (_FIELD_BITS - 6), np.int64)
    for row in rows:
        field[row["word"]] = row["bits"]
    return np.unpackbits(field.view(np.uint8), bitorder="little").astype(bool)


def _regions(field_bytes: bytes, masks: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.unpackbits(np.frombuffer(field_bytes, np.uint8)).astype(bool)
        width = len(field).bit_length() - 1
        for batch in blocks(batches):
            words, texts = _words(batch)
            hits, seeds, spans = [], [], []
            for mask in masks:
                places = MASKS[mask]
                at, value = _seeds(words, texts, mask)
                one, two = _bits(value, width)
                passed = field[one]
                passed[passed] = field[two[passed]]
                hits.append(at[passed])
                seeds.append(value[passed])
                spans.append(np.full(int(passed.sum()), places[-1] + 1))
            if not hits:
                continue
            at, seed, span = np.concatenate(hits), np.concatenate(seeds), np.concatenate(spans)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, seed, span = at[order], seed[order], span[order]
            owner = np.searchsorted(texts, at, side="right") - 1
            low = np.maximum(at - _AROUND, texts[owner])
            high = np.minimum(at + span + _AROUND, texts[owner + 1])
            # Stretches of one text that overlap form one region.
            reach = np.maximum.accumulate(high)
            new = np.r_[True, (low[1:] > reach[:-1]) | (owner[1:] != owner[:-1])]
            first = np.flatnonzero(new)
            count = np.diff(np.r_[first, len(at)])
            start, end = low[first], np.maximum.reduceat(high, first)
            lists = np.r_[0, np.cumsum(end - start)].astype(np.int32)
            picked = np.repeat(start - lists[:-1], end - start) + np.arange(lists[-1])
            marks = np.r_[0, np.cumsum(count)].astype(np.int32)
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs[owner[first]]),
                    pa.array((start - texts[owner[first]]).astype(np.int32)),
                    pa.ListArray.from_arrays(lists, words[picked].view(np.int64)),
                    pa.ListArray.from_arrays(marks, (at - np.repeat(start, count)).astype(np.int32)),
                    pa.ListArray.from_arrays(marks, seed.view(np.int64)),
                ],
                ["doc_id", "start", "words", "at", "seeds"],
            )

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, start, words, key, item, item_words, offset in zip(
            *(batch.column(i).to_pylist() for i in range(7)), strict=True
        ):
            low, high = max(0, offset), min(len(words), offset + len(item_words))
            found = best_stretch(
                np.array(words[low:high]), np.array(item_words[low - offset : high - offset]), len(item_words)
            )
            if found:
                rows.append((doc, key, item, start + low + found[0], low - offset + found[0], found[1], found[2]))
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            ["doc_id", "item_key", "item_id", "doc_word", "item_word", "n_equal", "n_words"],
        )


def best_stretch(words: np.ndarray, item: np.ndarray, size: int) -> tuple[int, int, int] | None:
    """Place, equal words and length of the best stretch of two aligned sequences, if one counts."""
    length = min(STRETCH, size)
    if len(words) < length:
        return None
    same = words == item
    sums = np.r_[0, np.cumsum(same)]
    equal = sums[length:] - sums[:-length]
    at = int(equal.argmax())
    return (at, int(equal[at]), length) if equal[at] >= SIMILARITY * length - 1e-9 else None


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that it has leaked, with the best stretch.

    doc_id, item_id, doc_word and item_word (where the stretch starts, in words), n_equal, n_words.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    # Tells items apart that share an id or have none.
    items = items.withColumn("item_key", F.xxhash64("item_id", F.col("item_id").isNull(), "text"))
    seeds = checkpointed(items.mapInArrow(_item_seeds, "item_key long, item_at int, seed long, mask int"))
    masks = sorted(row["mask"] for row in seeds.select("mask").distinct().collect())
    field = np.packbits(bit_field(seeds)).tobytes()
    regions = checkpointed(
        named(docs, "doc_id", "text")
        .where("doc_id IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(
            _regions(field, masks), "doc_id long, start int, words array<long>, at array<int>, seeds array<long>"
        )
    )
    # The words tell regions of rows that share an id apart.
    regions = regions.withColumn("region", F.xxhash64("words"))
    one = ["doc_id", "start", "region"]
    hits = regions.select(*one, F.explode(F.arrays_zip("at", "seeds")).alias("hit"))
    hits = hits.select(*one, "hit.at", F.col("hit.seeds").alias("seed"))
    places = (
        hits.join(seeds.hint("merge"), "seed")
        .select(*one, "item_key", (F.col("at") - F.col("item_at")).alias("offset"))
        .distinct()
    )
    words = items.mapInArrow(_item_words, "item_key long, item_id long, item_words array<long>")
    paired = (
        places.join(regions.select(*one, "words").dropDuplicates(one), one)
        .join(words.dropDuplicates(["item_key"]), "item_key")
        .select("doc_id", "start", "words", "item_key", "item_id", "item_words", "offset")
    )
    found = paired.mapInArrow(
        _verify,
        "doc_id long, item_key long, item_id long, doc_word long, item_word long, n_equal long, n_words long",
    )
    best = F.max(F.struct("n_equal", -F.col("doc_word"), -F.col("item_word"), "n_words")).alias("best")
    return (
        found.groupBy("doc_id", "item_id", F.when(F.col("item_id").isNull(), F.col("item_key")).alias("unnamed"))
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            (-F.col("best.col2")).alias("doc_word"),
            (-F.col("best.col3")).alias("item_word"),
            "best.n_equal",
            "best.n_words",
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that have leaked no item, with all columns."""
    leaked = leaks(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).distinct()
    return docs.join(leaked.hint("merge"), F.col("doc_id").cast("long") == F.col("leaked_id"), "left_anti")
