"""Removal of repeated 35-word windows, found by recompression.

A document is a sequence of words. Each round first names runs of equal symbols (symbol and length) and
then pairs: every symbol draws a side by its name, and a left one followed by a right one become one symbol. Names are
64-bit hashes of what they stand for, so all tasks name alike and a round needs no shuffle; equal
stretches get equal symbols except near their ends.

How far the ends reach is kept exactly: each symbol carries the interval of words that determines it (the
neighbours looked at to see that a run ends or that no pair forms, and what determined those). A symbol whose interval lies
inside a window exists, at the same place, wherever that window's words stand. The anchor of a
window is taken from the highest round of which it determines at least `_CHOICE` symbols: the one with
the least hash, the first of equals. Single words determine themselves, so there always is one. Equal windows therefore share their anchor, and a repeat can
only be where high symbols are shared. Shared symbols are verified: whole stretches of windows
around a symbol by 96-bit hashes (`repeats`), and windows of stretches that differ by 128-bit hashes of
their own.

Defined results: words are runs of bytes other than 0x20 and 0x09 to 0x0D, compared as they are; a null text has no
words; texts under 35 words stay whole; windows may overlap the ones they repeat (long runs of
one word go altogether); repeated rows remove each other, also when they share an id; rows
without an id take part like any other, and any number of rows may have no id or the same one; an empty table
gives no rows; texts of any length are read whole.
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
from tidemart.llm.words import BLANK, RollingHash, mixed, split_words, word_hashes

WINDOW = 35
_ROUNDS = 24
# Symbols that a window has to determine in the round that its anchor is taken from.
_CHOICE = 12
_ROUND = 0xD6E8FEB86659FD93
_SECOND = 0xC2B2AE3D27D4EB4F
# Windows that a task compares before it passes them on.
_COLLECTED = 1 << 19


def _symbols(words: np.ndarray, texts: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Name, determining interval (from, to), first word and end of all symbols of every round.

    Round 0 is the words.
    """
    text = np.repeat(np.arange(len(texts) - 1), np.diff(texts))
    # Beyond the ends of a text nothing is determined.
    before, behind = texts[:-1] - 1, texts[1:] + 1
    name, low, high = words, np.arange(len(words)), np.arange(len(words)) + 1
    begin = low
    rounds = [(name, low, high, begin, high)]
    for number in range(1, _ROUNDS):
        step = np.uint64(_ROUND * 2 * number % (1 << 64))
        # Runs.
        inner = text[1:] == text[:-1]
        first = np.r_[True, (name[1:] != name[:-1]) | ~inner]
        start = np.flatnonzero(first)
        end = np.r_[start[1:], len(name)]
        length = (end - start).astype(np.uint64)
        left, right = np.maximum(start - 1, 0), np.minimum(end, len(name) - 1)
        own = text[start]
        run_low = np.where((start > 0) & (text[left] == own), low[left], before[own])
        run_high = np.where((end < len(name)) & (text[right] == own), high[right], behind[own])
        name = np.where(length > 1, mixed(name[start] + step + length * np.uint64(0x9E3779B97F4A7C15)), name[start])
        low, high, text, begin = run_low, run_high, own, begin[start]
        # Pairs.
        side = ((mixed(name + step + np.uint64(1)) >> np.uint64(17)) & np.uint64(1)).astype(bool)
        inner = np.r_[text[1:] == text[:-1], False]
        follows = np.r_[side[1:], False]
        pair = ~side & follows & inner
        second = np.r_[False, pair[:-1]]
        # An unpaired left symbol has looked at its right neighbour, a right one at its left one.
        next_high = np.where(inner, np.r_[high[1:], 0], behind[text])
        last_low = np.where(np.r_[False, inner[:-1]], np.r_[0, low[:-1]], before[text])
        new_low = np.where(~pair & side, last_low, low)
        new_high = np.where(pair | ~side, next_high, high)
        joined = mixed(name * np.uint64(3) + np.r_[name[1:], np.uint64(0)] * np.uint64(_ROUND) + step)
        keep = ~second
        name = np.where(pair, joined, name)[keep]
        low, high, text, begin = new_low[keep], new_high[keep], text[keep], begin[keep]
        if not ((high - low <= WINDOW) & (low > before[text]) & (high < behind[text])).any():
            break
        rounds.append((name, low, high, begin, np.r_[begin[1:], len(words)]))
    return rounds


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place of the least value, the first of equals, in each of the ranges first .. last."""
    width = last - first + 1
    best = np.arange(len(values))
    found = first.copy()
    size = 1
    while len(width) and size <= width.max():
        # best[i] is the place of the least of `size` values from i on.
        here = np.flatnonzero((width >= size) & (width < 2 * size))
        one, two = best[first[here]], best[last[here] - size + 1]
        found[here] = np.where(values[two] < values[one], two, one)
        one, two = best[:-size], best[size:]
        best = np.where(values[two] < values[one], two, one)
        size *= 2
    return found


def segments_of_words(words: np.ndarray, texts: np.ndarray) -> Segments:
    room = np.repeat(texts[1:], np.diff(texts)) - np.arange(len(words))
    open_ = np.flatnonzero(room >= WINDOW)
    windows = open_
    symbol = np.zeros(len(words), np.int64)
    anchor = np.zeros(len(words), np.uint64)
    begin, end = np.zeros((2, len(words)), np.int64)
    base = 0
    levels = _symbols(words, texts) if len(open_) else []
    for number in range(len(levels) - 1, -1, -1):
        name, low, high, begins, ends = levels[number]
        first = np.searchsorted(low, open_)
        last = np.searchsorted(high, open_ + WINDOW, side="right") - 1
        fits = last - first + 1 >= (_CHOICE if number else 1)
        at = _least(mixed(name + np.uint64(number)), first[fits], last[fits])
        symbol[open_[fits]] = base + at
        anchor[open_[fits]] = mixed(name[at] + np.uint64(number))
        begin[open_[fits]], end[open_[fits]] = begins[at], ends[at]
        open_ = open_[~fits]
        base += len(name)
    if not len(windows):
        return Segments.joined([])
    symbol, anchor = symbol[windows], anchor[windows]
    new = np.r_[True, (symbol[1:] != symbol[:-1]) | (windows[1:] != windows[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(windows)] - 1
    start, stop = windows[first], windows[last] + WINDOW
    text = np.searchsorted(texts, start, side="right") - 1
    rolling = RollingHash(words)
    begin, end = begin[start], end[start]
    # A window holds half of its other words, or more, before its anchor or behind it.
    side = np.maximum(WINDOW - (end - begin), 0) // 2
    left = _mark(rolling, begin - side, begin, begin - side >= start)
    right = _mark(rolling, end, end + side, end + side <= stop)
    return Segments(anchor[first], rolling(start, stop), text, start - texts[text], stop - start, left, right)


def _mark(rolling: RollingHash, start: np.ndarray, end: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """32 bits of the words on one side of an anchor, 0 where the stretch does not reach so far."""
    hashes = rolling(np.where(inside, start, 0), np.where(inside, end, 0)) >> np.uint64(32)
    return np.where(inside, np.maximum(hashes, np.uint64(1)), np.uint64(0)).astype(np.int64)


def segments(flat: np.ndarray, offsets: np.ndarray) -> Segments:
    """Stretches of consecutive windows with one anchor."""
    starts, ends, texts = split_words(flat, offsets, BLANK)
    return segments_of_words(word_hashes(flat, starts, ends), texts)


_WINDOWS = "w1 long, w2 long, doc_id long, twin long, verdict long, weight int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of contested stretches; those that repeat within a task are settled."""

    def send(pending: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        one, two, doc, twin, name, weight = (np.concatenate(c) for c in zip(*pending, strict=True))
        order = np.lexsort((two, one))
        one, two, doc, twin, name, weight = (c[order] for c in (one, two, doc, twin, name, weight))
        first = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        sizes = np.diff(np.r_[first, len(one)])
        many = np.add.reduceat(weight, first) > 1
        # Settled ones get weight 0; one of every group goes on for the other tasks.
        settled = np.flatnonzero(np.repeat(many, sizes) & (weight == 1))
        lone = first[~many]
        groups = first[many]
        take = np.r_[settled, lone, groups]
        kind = np.r_[np.zeros(len(settled)), np.ones(len(lone)), np.full(len(groups), 2)].astype(np.int32)
        # What is settled needs not meet others of its window any more and is spread; one of its group may go on as well.
        one = np.r_[mixed(name[settled].view(np.uint64)), one[lone], one[groups]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.view(np.int64)) for c in (one, *(c[take] for c in (two, doc, twin, name)))] + [pa.array(kind)],
            ["w1", "w2", "doc_id", "twin", "verdict", "weight"],
        )

    pending, count = [], 0
    for batch in batches:
        numbers = batch.column("verdicts")
        for row, (doc, twin, zipped) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("doc_id", "twin", "zipped")), strict=True)
        ):
            if not numbers[row].is_valid:
                continue
            listed = numbers[row].values.to_numpy()
            if not any_contested(listed):
                continue
            flat = np.frombuffer(unzipped(zipped), np.uint8)
            offsets = np.array([0, len(flat)])
            check = int(checks_of(flat, offsets)[0])
            own = verdicts_of(listed, check)
            if not own.contested.any():
                continue
            starts, ends, _ = split_words(flat, offsets, BLANK)
            first, second = (RollingHash(word_hashes(flat, starts, ends, m), m) for m in (_SECOND, _SECOND * 5 + 2))
            begin, length = own.start[own.contested], own.length[own.contested]
            each = length - WINDOW + 1
            at = np.repeat(begin - np.r_[0, np.cumsum(each)[:-1]], each) + np.arange(each.sum())
            weight = np.repeat(np.where(own.reference[own.contested], 2, 1), each)
            name = verdict(np.full(len(at), check), at, np.full(len(at), WINDOW))
            whose = (np.full(len(at), doc), np.full(len(at), twin))
            pending.append((first(at, at + WINDOW), second(at, at + WINDOW), *whose, name, weight))
            count += len(at)
            if count >= _COLLECTED:
                yield send(pending)
                pending, count = [], 0
    if pending:
        yield send(pending)


def _settle_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by window; windows of a total weight over one are settled."""

    def decide(table: pa.Table) -> pa.RecordBatch:
        one, two, doc, twin, name, weight = (
            table.column(c).combine_chunks().to_numpy() for c in ("w1", "w2", "doc_id", "twin", "verdict", "weight")
        )
        new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
        group = np.cumsum(new) - 1
        many = np.bincount(group, weight)[group] > 1
        done = (weight == 0) | ((weight == 1) & many)
        return settled_rows(doc[done], twin[done], name[done])

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        key = table.column("w1").combine_chunks().to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield decide(table.slice(0, cut))
        rest = table.slice(cut)
    if rest is not None:
        yield decide(rest)


def _resolved(judged: Judged) -> DataFrame:
    found = (
        judged.joined()
        .mapInArrow(_windows, _WINDOWS)
        .repartition("w1")
        .sortWithinPartitions("w1", "w2")
        .mapInArrow(_settle_windows, VERDICTS)
    )
    return lists(found, "resolved")


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = [batch.column("verdicts"), batch.column("resolved")]
        for row, (doc, copies, zipped) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("doc_id", "copies", "zipped")), strict=True)
        ):
            text = unzipped(zipped)
            words = text.split()
            numbers = [own[row].values.to_numpy() for own in columns if own[row].is_valid]
            gone = np.zeros(len(words), bool)
            if numbers:
                flat = np.frombuffer(text, np.uint8)
                check = int(checks_of(flat, np.array([0, len(flat)]))[0])
                for own in numbers:
                    gone |= covered(verdicts_of(own, check), len(words))
            if gone.any():
                kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
            else:
                kept = words
            rows.append((doc, copies, len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
        values = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [*[pa.int64()] * 4, pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(values, kinds, strict=True)],
            ["doc_id", "copies", "n_words", "n_removed", "kept_sha256"],
        )


def dedup_windows(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words that stay."""
    judged = judge(docs, segments, smaller_id_only=False, marks=np.uint32)
    report = "doc_id long, copies long, n_words long, n_removed long, kept_sha256 string"
    return judged.given(judged.joined(_resolved(judged)).mapInArrow(_reported, report))
