from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm import fingerprints as own


@pytest.mark.parametrize(
    "ids", [[5], [1, 2, 3], [-5, 0, 7, 1 << 40, (1 << 62) + 5, -(1 << 61), 300, 299, 256, 255, 512], list(range(0, 3000, 7)), []]
)
def test_next_document_and_edit(spark, ids):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choices("ab cdé🙂 ", k=draw.randint(0, 30)))) for i in ids]
    found = own.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    ordered = sorted(rows, reverse=True)
    want = {}
    for place, (doc, text) in enumerate(ordered):
        cut, following = len(text) // 3, ordered[(place + 1) % len(ordered)][1]
        want[doc] = (len(text), hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest())
    assert {row.doc_id: (row.n_chars, row.edited_sha256) for row in found} == want


def test_winnowing_keeps_the_rightmost_least_hash_of_every_window(spark):
    draw = random.Random(4)
    texts = [" ".join(draw.choices("abcde", k=draw.randint(0, 40))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = own.winnow(own.F.col("text"))
    grams = "transform(sequence(0, size(w) - 3), i -> xxhash64(xxhash64(w[i]), xxhash64(w[i + 1]), xxhash64(w[i + 2])))"
    rows = (
        frame.withColumn("w", own.F.expr("filter(split(text, ' '), x -> x <> '')"))
        .withColumn("g", own.F.expr(f"IF(size(w) >= 3, {grams}, CAST(array() AS ARRAY<LONG>))"))
        .select("w", "g", own.hashes_of(marks).alias("h"), own.positions_of(marks).alias("p"))
        .collect()
    )
    for row in rows:
        values = [(g % (1 << 64)) >> 33 for g in row.g]
        if len(row.w) < 3:
            assert len(row.h) == (1 if row.w else 0)
            continue
        width = own.WINDOW if len(values) >= own.WINDOW else len(values)
        want = []
        for start in range(len(values) - width + 1):
            place = min(range(start, start + width), key=lambda i: (values[i], -i))
            if place not in want:
                want.append(place)
        assert row.p == want and row.h == [values[i] for i in want]


def test_shared_words_are_found_and_equal_texts_are_equal(spark):
    shared = "one two three four five six seven eight"
    rows = [(1, f"aa bb cc {shared} dd"), (2, f"{shared} ee ff gg hh ii"), (3, f"{shared} ee ff gg hh ii"), (4, "other words here")]
    found = {row.doc_id: row for row in own.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    cut = lambda text: {text[i : i + 8] for i in range(0, len(text), 8)}
    assert cut(found[1].fingerprint) & cut(found[2].fingerprint)
    assert found[2].fingerprint == found[3].fingerprint and found[3].near_next == 1.0
    assert found[4].near_next == 0.0


def test_awkward_rows(spark):
    found = own.fingerprint_documents(spark.createDataFrame(awkward(), COLUMNS)).collect()
    assert len(found) == len(awkward())
    assert all(0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1 for row in found)
    assert {row.fingerprint for row in found if row.doc_id in (3, 4)} == {""}
