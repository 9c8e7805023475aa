from __future__ import annotations

import random
from math import log2

import numpy as np

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm import language as own


def _bits(text: str, counts: dict[bytes, int]) -> float:
    """Code length by the definition, from counts of four-byte strings."""
    tables: dict[bytes, dict[int, int]] = {}
    for gram, n in counts.items():
        for order in range(4):
            table = tables.setdefault(gram[3 - order : 3], {})
            table[gram[3]] = table.get(gram[3], 0) + n

    def chances(context: bytes) -> dict[int, float]:
        below = {byte: 1 / 256 for byte in range(256)} if not context else chances(context[1:])
        if not context:
            return mix(tables.get(b"", {}), below)
        return mix(tables[context], below) if context in tables else below

    def mix(table: dict[int, int], below: dict[int, float]) -> dict[int, float]:
        total, distinct = sum(table.values()), len(table)
        if not total:
            return below
        left = sum(p for byte, p in below.items() if byte not in table)
        if left <= 0:
            return {byte: table.get(byte, 0) / total for byte in below}
        escape = distinct / (total + distinct)
        return {
            byte: table[byte] / (total + distinct) if byte in table else escape * p / left for byte, p in below.items()
        }

    data = b"   " + text.lower().encode()
    return sum(-log2(chances(data[i - 3 : i])[data[i]]) for i in range(3, len(data)))


def test_code_lengths_follow_the_definition():
    draw = random.Random(1)
    counts = {}
    for name, letters in (("one", "abcd "), ("two", "cdexyz ")):
        text = "   " + "".join(draw.choices(letters, k=400))
        grams: dict[bytes, int] = {}
        for i in range(3, len(text)):
            gram = text[i - 3 : i + 1].encode()
            grams[gram] = grams.get(gram, 0) + 1
        counts[name] = grams
    model = own.build({name: [(int.from_bytes(g, "big"), n) for g, n in grams.items()] for name, grams in counts.items()})
    texts = ["abcd dcba", "xyz zyx", "", "Qé abc", "c" * 50]
    found = own.code_lengths(model, texts)
    want = [[_bits(text, counts[name]) for name in ("one", "two")] for text in texts]
    assert np.allclose(found, want, rtol=1e-4)


def test_steps_do_not_change_code_lengths(monkeypatch):
    model = own.build({"a": [(int.from_bytes(b"abca", "big"), 3)], "b": [(int.from_bytes(b"xyzx", "big"), 2)]})
    texts = ["abcabca", "", "xyz" * 40, "q", "abc" * 33]
    whole = own.code_lengths(model, texts)
    monkeypatch.setattr(own, "_STEP", 7)
    assert np.allclose(own.code_lengths(model, texts), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = own.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(row.lang == row.lang_pred for row in found) >= 0.98 * len(found) > 200


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    found = own.identify(docs)
    rows = {row.doc_id: row for row in found.collect()}
    assert found.count() == len(awkward())
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (3, 4, 5, 6))
    kept = own.keep_identified(docs)
    assert kept.columns == docs.columns and {3, 4, 5, 6}.isdisjoint({row.doc_id for row in kept.collect()})
    unlabelled = docs.withColumn("lang", own.F.lit(None).cast("string"))
    assert {row.lang_pred for row in own.identify(unlabelled).collect()} == {"und"}
    assert own.identify(spark.createDataFrame([], COLUMNS)).count() == 0
