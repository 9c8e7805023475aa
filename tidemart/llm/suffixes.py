"""Removal of 50-byte strings that also start in a document with a smaller id, by suffix sorting.

The suffixes to sort are cut down and dealt into buckets first. Of the 35 strings of 16 bytes in each
50-byte string the one with the least hash (the first of equals) is its anchor; equal strings have
equal anchors. Strings whose whole neighbourhood repeats are settled by hashes of the stretch
(`repeats`); what is left are stretches around an anchor that others have too, mostly the edges of
copied passages.

These form suffix buckets, one for each anchor, and are sorted blockwise, some buckets at a time: all
suffixes of a block are put in order by their first 7 bytes; longer ties are resolved by ranks of the
positions of a difference cover modulo 7, {0, 1, 3}, computed beforehand: any two suffixes have
a distance below 7 at which both are in the cover. Neighbours in that order that share 50 bytes
form a class, and all of a class but those of its smallest id go.

A bucket with very many different stretches is dealt by its 50-byte strings instead, after every task has
settled those that repeat within the task.

Defined results: a null text counts as empty; texts under 50 bytes stay whole; rows that share an id do not remove
each other's bytes; equal strings within one document alone stay; rows without an id count as the
smallest id, and any number of rows may have no id or the same one; an empty table gives no rows; texts of any length
are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemart.llm.repeats import (
    VERDICTS,
    Judged,
    Segments,
    any_contested,
    checks_of,
    covered,
    judge,
    lists,
    settled_rows,
    unzipped,
    verdict,
    verdicts_of,
)
from tidemart.llm.words import RollingHash, byte_values, mixed

LENGTH = 50
GRAM = 16
_GRAMS = LENGTH - GRAM + 1
# A 50-byte string holds so many bytes before its anchor, or so many behind it.
_SIDE = (LENGTH - GRAM) // 2
# A difference cover, and its period.
COVER, PERIOD = (0, 1, 3), 7
# Bytes of text looked at in one step, and suffixes sorted in one block: as many as a processor's caches hold.
_STEP = 1 << 17
_BLOCK = 1 << 16
# Bytes of contested stretches that a task collects before it passes them on.
_PASSED = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def _run_starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def segments(flat: np.ndarray, offsets: np.ndarray) -> Segments:
    """Stretches of consecutive 50-byte strings with one anchor, `_STEP` strings at a time."""
    found: list[tuple[np.ndarray, ...]] = []
    for base in range(0, max(0, len(flat) - LENGTH + 1), _STEP):
        piece = flat[base : base + _STEP + LENGTH - 1]
        rolling = RollingHash(byte_values(piece))
        grams = rolling.every(GRAM)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        for shift in (1, 2, 4, 8, 16, _GRAMS - 32):
            least = np.minimum(least[:-shift], least[shift:])
        place = (least & _PLACE).astype(np.int64)
        at = np.arange(len(place))
        # Texts that begin at or before the step, and in it; the last one to begin at a place stands there.
        low, high = np.searchsorted(offsets, (base, base + len(at)), side="right") - 1
        edges = np.r_[0, offsets[low + 1 : high + 1] - base, len(at)]
        text = np.repeat(np.arange(low, high + 1), np.diff(edges))
        inside = np.flatnonzero(base + at + LENGTH <= np.r_[offsets, offsets[-1]][text + 1])
        if not len(inside):
            continue
        place, text = place[inside], text[inside]
        first = _run_starts(place, text)
        last = np.r_[first[1:], len(inside)] - 1
        start, end, anchor = inside[first], inside[last] + LENGTH, place[first]
        found.append(
            (
                grams[anchor], rolling(start, end), text[first], base + start - offsets[text[first]], end - start,
                _mark(rolling, anchor - _SIDE, anchor, anchor - _SIDE >= start),
                _mark(rolling, anchor + GRAM, anchor + GRAM + _SIDE, anchor + GRAM + _SIDE <= end),
            )
        )
    return Segments.joined(found)


def _mark(rolling: RollingHash, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """16 bits of the bytes on one side of an anchor, 0 where the stretch does not reach so far."""
    hashes = rolling(np.where(inside, start, 0), np.where(inside, end, 0)) >> np.uint64(48)
    return np.where(inside, np.maximum(hashes, np.uint64(1)), np.uint64(0)).astype(np.int64)


_CONTENT = "bucket long, doc_id long, verdict long, content binary, twin long"


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of every contested stretch, by the bucket it belongs to."""
    for batch in batches:
        docs: list[int] = []
        twins: list[int] = []
        names: list[np.ndarray] = []
        contents: list[bytes] = []
        held = 0
        crowded: list[tuple[np.ndarray, ...]] = []
        numbers = batch.column("verdicts")
        for row, (doc, twin, zipped) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("doc_id", "twin", "zipped")), strict=True)
        ):
            if not numbers[row].is_valid:
                continue
            listed = numbers[row].values.to_numpy()
            if not any_contested(listed):
                continue
            text = unzipped(zipped)
            flat = np.frombuffer(text, np.uint8)
            check = int(checks_of(flat, np.array([0, len(flat)]))[0])
            own = verdicts_of(listed, check)
            open_ = own.contested & ~own.hot
            start, length = own.start[open_], own.length[open_]
            docs.extend([doc] * len(start))
            twins.extend([twin] * len(start))
            names.append(verdict(np.full(len(start), check), start, length))
            contents.extend(
                [text[low:high] for low, high in zip(start.tolist(), (start + length).tolist(), strict=True)]
            )
            held += int(length.sum())
            if own.hot.any():
                count = own.length[own.hot] - LENGTH + 1
                first = np.repeat(own.start[own.hot] - np.r_[0, np.cumsum(count)[:-1]], count)
                at = first + np.arange(count.sum())
                crowded.append(
                    (
                        RollingHash(byte_values(flat))(at, at + LENGTH),
                        np.full(len(at), doc),
                        verdict(np.full(len(at), check), at, np.full(len(at), LENGTH)),
                        np.lib.stride_tricks.sliding_window_view(flat, LENGTH)[at],
                        np.full(len(at), twin),
                    )
                )
            if held >= _PASSED:
                yield _rows(_anchors(contents), docs, np.concatenate(names), contents, twins)
                docs, twins, names, contents, held = [], [], [], [], 0
        if docs:
            yield _rows(_anchors(contents), docs, np.concatenate(names), contents, twins)
        if crowded:
            yield _rows(*_distinct(*(np.concatenate(column) for column in zip(*crowded, strict=True))))


def _rows(bucket, docs, names, contents, twins) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip((bucket, docs, names, contents, twins), kinds, strict=True)],
        ["bucket", "doc_id", "verdict", "content", "twin"],
    )


def _anchors(contents: list[bytes]) -> np.ndarray:
    """Least hash among the strings of 16 bytes of each stretch."""
    flat = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.array([len(content) for content in contents], np.int64)
    begins = np.cumsum(sizes) - sizes
    grams = RollingHash(byte_values(flat)).every(GRAM) & ~_PLACE
    # The strings that reach into the next stretch are left out of the sums.
    marks = np.stack([begins, np.minimum(begins + sizes - GRAM + 1, len(grams))], axis=1).ravel()
    grams = np.r_[grams, ~np.uint64(0)]
    return np.minimum.reduceat(grams, marks)[::2].view(np.int64)


def _distinct(key: np.ndarray, doc: np.ndarray, name: np.ndarray, windows: np.ndarray, twin: np.ndarray) -> tuple:
    """Strings of a crowded bucket: the smallest id of each goes on, the others are settled (no content)."""
    order = np.lexsort((name, doc, key))
    key, doc, name, windows, twin = (column[order] for column in (key, doc, name, windows, twin))
    first = _run_starts(key)
    smallest = np.repeat(doc[first], np.diff(np.r_[first, len(key)]))
    goes_on = doc == smallest
    contents = [w.tobytes() if own else None for w, own in zip(windows, goes_on, strict=True)]
    # What is settled has no bucket any more and is spread.
    return np.where(goes_on, key, mixed(name.view(np.uint64))).view(np.int64), doc, name, contents, twin


def _eights(padded: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; none for the last seven."""
    value = padded.astype(np.uint64)
    for width in (1, 2, 4):
        value = (value[:-width] << np.uint64(8 * width)) | value[width:]
    return value


def _words_at(eights: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The 50 bytes at each place as seven numbers that sort like them; the last ones are masked."""
    words = [eights[at + place] for place in range(0, LENGTH, 8)]
    words[-1] &= ~np.uint64(0) << np.uint64(8 * (-LENGTH % 8))
    return words


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense rank of rows under several keys, the first one counting most."""
    order = np.lexsort(keys[::-1])
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.cumsum(_changes([key[order] for key in keys]))
    return rank


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    """Rows that differ from the one before; the first one does not."""
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


# Odd numbers without a pattern.
_FACTORS = np.random.default_rng(20240301).integers(1, 1 << 63, 2 + LENGTH // 8, dtype=np.uint64) | np.uint64(1)


def _ranks_of_copies(keys: list[np.ndarray]) -> np.ndarray:
    """The same where many rows are equal: one of each is ranked. Equal rows are found by a hash, and compared."""
    hashes = np.zeros(len(keys[0]), np.uint64)
    for key, factor in zip(keys, _FACTORS, strict=True):
        hashes += (key ^ (key >> np.uint64(32))) * factor
    hashes = mixed(hashes)
    order = np.argsort(hashes)
    new = _changes([hashes[order]])
    if (_changes([key[order] for key in keys]) & ~new).any():
        return _ranks(keys)
    first = order[np.r_[0, np.flatnonzero(new)]] if len(order) else order
    rank = np.zeros(len(order), np.int64)
    rank[order] = _ranks([key[first] for key in keys])[np.cumsum(new)]
    return rank


def _meeting() -> np.ndarray:
    """For two places modulo the period, the distance at which both are in the cover."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for one in range(PERIOD):
        for two in range(PERIOD):
            table[one, two] = next(
                d for d in range(PERIOD) if (one + d) % PERIOD in COVER and (two + d) % PERIOD in COVER
            )
    return table


def sorted_suffixes(
    flat: np.ndarray, ends: np.ndarray, at: np.ndarray, bucket: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by (bucket, first 50 bytes), and where a new class of equal ones begins.

    `ends` gives for every byte the end of its stretch; suffixes begin at `at` and are at least 50 bytes long.
    """
    padded = np.r_[flat, np.zeros(2 * LENGTH, np.uint8)]
    eights = _eights(padded)
    # Ties of up to PERIOD bytes by the bytes themselves.
    tie = _ranks([bucket, eights[at] >> np.uint64(8 * (8 - PERIOD))])
    # Ranks of the cover's positions by 50 bytes; past the end of a stretch there is nothing to compare.
    cover = np.arange(len(flat))
    cover = cover[np.isin(np.arange(PERIOD), COVER)[cover % PERIOD]]
    keys = _words_at(eights, cover)
    left = np.minimum(ends[cover] - cover, LENGTH)
    cut = np.flatnonzero(left < LENGTH)
    for number, key in enumerate(keys):
        missing = np.clip(8 * (number + 1) - left[cut], 0, 8).astype(np.uint64)
        whole = missing == 8
        mask = ~np.uint64(0) << (np.where(whole, 0, missing).astype(np.uint64) * np.uint64(8))
        key[cut] = np.where(whole, np.uint64(0), key[cut] & mask)
    rank = np.zeros(len(padded), np.int64)
    rank[cover] = _ranks_of_copies([*keys, left.astype(np.uint64)])
    # Place of every suffix within its tie: how many of each residue class are smaller.
    meeting, residue = _meeting(), at % PERIOD
    width, ties = int(rank.max(initial=0)) + 2, int(tie.max(initial=-1)) + 1
    place = np.zeros(len(at), np.int64)
    members = [np.flatnonzero(residue == r) for r in range(PERIOD)]
    # Of each class, how many suffixes have a smaller tie, and its order by the ranks at each distance.
    smaller = [np.cumsum(np.bincount(tie[own], minlength=ties)) - np.bincount(tie[own], minlength=ties) for own in members]
    sides: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for one, own in enumerate(members):
        for distance in set(meeting[one].tolist()):
            key = tie[own] * width + rank[at[own] + distance]
            by_key = np.argsort(key)
            sides[one, distance] = own[by_key], key[by_key]
    for one, own in enumerate(members):
        for two, other in enumerate(members):
            if not len(own) or not len(other):
                continue
            distance = int(meeting[one, two])
            (whose, mine), (_, theirs) = sides[one, distance], sides[two, distance]
            place[whose] += np.searchsorted(theirs, mine, side="right" if two < one else "left") - smaller[two][tie[whose]]
    order = np.argsort(tie * (int(place.max(initial=0)) + 1) + place)
    sorted_at = at[order]
    words = _words_at(eights, sorted_at)
    new = np.ones(len(order), bool)
    new[1:] = bucket[order][1:] != bucket[order][:-1]
    for word in words:
        new[1:] |= word[1:] != word[:-1]
    return order, new


def _sort_block(
    bucket: np.ndarray, doc: np.ndarray, name: np.ndarray, twin: np.ndarray, contents: list[bytes]
) -> pa.RecordBatch:
    """Verdicts on the stretches of whole buckets: runs of suffixes that a smaller id has as well."""
    flat = np.frombuffer(b"".join(contents), np.uint8)
    sizes = np.array([len(content) for content in contents], np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes - LENGTH + 1)
    at = np.repeat(begins - np.r_[0, np.cumsum(sizes - LENGTH + 1)[:-1]], sizes - LENGTH + 1) + np.arange(len(owner))
    order, new = sorted_suffixes(flat, np.repeat(begins + sizes, sizes), at, bucket[owner])
    first = np.flatnonzero(new)
    docs = doc[owner[order]]
    smallest = np.repeat(np.minimum.reduceat(docs, first), np.diff(np.r_[first, len(order)]))
    gone = np.zeros(len(at), bool)
    gone[order[docs > smallest]] = True
    gone = np.flatnonzero(gone)
    if not len(gone):
        return settled_rows([], [], [])
    # Consecutive suffixes of a stretch form one run.
    run = np.flatnonzero(np.r_[True, (gone[1:] != gone[:-1] + 1) | (owner[gone[1:]] != owner[gone[:-1]])])
    last = gone[np.r_[run[1:], len(gone)] - 1]
    whose = owner[gone[run]]
    shift = at[gone[run]] - begins[whose]
    length = at[last] - at[gone[run]] + LENGTH
    # The verdict of the stretch, with start and length of the run.
    return settled_rows(doc[whose], twin[whose], ((name[whose] >> 7) + shift) << 7 | length)


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; as many whole buckets as make up a block are sorted together."""
    held: list[pa.RecordBatch] = []
    count = 0

    def flush(table: pa.Table) -> pa.RecordBatch:
        names = ("bucket", "doc_id", "verdict", "twin")
        columns = [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names]
        return _sort_block(*columns, table.column("content").to_pylist())

    for batch in batches:
        known = batch.column("content").is_null().to_numpy(zero_copy_only=False)
        if known.any():
            done = batch.filter(pa.array(known))
            yield settled_rows(*(done.column(c) for c in ("doc_id", "twin", "verdict")))
            batch = batch.filter(pa.array(~known))
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.column("content").nbytes - LENGTH * batch.num_rows
        if count < 4 * _BLOCK:
            continue
        table = pa.Table.from_batches(held)
        key = table.column("bucket").combine_chunks().to_numpy()
        # The last bucket may go on in the next batch.
        cut = int(np.searchsorted(key, key[-1]))
        for low, high in _slices(key[:cut], table.column("content")):
            yield flush(table.slice(low, high - low))
        held = table.slice(cut).combine_chunks().to_batches()
        count = 0
    if held:
        table = pa.Table.from_batches(held)
        for low, high in _slices(table.column("bucket").combine_chunks().to_numpy(), table.column("content")):
            yield flush(table.slice(low, high - low))


def _slices(key: np.ndarray, contents: pa.ChunkedArray) -> list[tuple[int, int]]:
    """Ranges of whole buckets of about `_BLOCK` suffixes."""
    if not len(key):
        return []
    sizes = np.concatenate([np.diff(np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]) for c in contents.chunks])[: len(key)]
    total = np.cumsum(sizes.astype(np.int64) - LENGTH + 1)
    ends = np.r_[_run_starts(key)[1:], len(key)]
    cuts, low = [], 0
    for end in ends:
        if end == len(key) or total[end - 1] - (total[low - 1] if low else 0) >= _BLOCK:
            cuts.append((low, int(end)))
            low = int(end)
    return cuts


def _resolved(judged: Judged) -> DataFrame:
    found = (
        judged.joined()
        .mapInArrow(_contents, _CONTENT)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sort_buckets, VERDICTS)
    )
    return lists(found, "resolved")


def removed_bytes(flat: np.ndarray, verdicts: list[np.ndarray]) -> np.ndarray:
    """Which bytes of a text go."""
    check = int(checks_of(flat, np.array([0, len(flat)]))[0])
    gone = np.zeros(len(flat), bool)
    for numbers in verdicts:
        gone |= covered(verdicts_of(numbers, check), len(flat))
    return gone


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        lists_ = [batch.column("verdicts"), batch.column("resolved")]
        for row, (doc, copies, zipped) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copies", "zipped")), strict=True)
        ):
            text = unzipped(zipped)
            flat = np.frombuffer(text, np.uint8)
            numbers = [own[row].values.to_numpy() for own in lists_ if own[row].is_valid]
            if numbers:
                gone = removed_bytes(flat, numbers)
                spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
                text = flat[~gone].tobytes()
                rows.append((doc, copies, len(flat), int(gone.sum()), spans, hashlib.sha256(text).hexdigest()))
            else:
                rows.append((doc, copies, len(flat), 0, 0, hashlib.sha256(text).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = [*[pa.int64()] * 5, pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            ["doc_id", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def dedup_suffixes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes that stay."""
    judged = judge(docs, segments, smaller_id_only=True)
    report = "doc_id long, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return judged.given(judged.joined(_resolved(judged)).mapInArrow(_reported, report))
