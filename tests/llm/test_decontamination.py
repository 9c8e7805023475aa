from __future__ import annotations

import itertools
import random

import pytest

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm import decontamination as own

ITEMS = "item_id long, text string"


def _brute(words: list[str], item: list[str]):
    best, length = None, min(own.STRETCH, len(item))
    for offset in range(-len(item), len(words) + 1):
        for place in range(len(item) - length + 1):
            if offset + place < 0 or offset + place + length > len(words):
                continue
            same = [words[offset + place + j] == item[place + j] for j in range(length)]
            if sum(same) < 0.8 * length - 1e-9:
                continue
            if any(all(same[at + x] for x in mask) for mask in own.MASKS for at in range(length - mask[-1])):
                found = (sum(same), -(offset + place), -place)
                best = found if best is None or found > best else best
    return best


def test_masks_miss_no_stretch_with_three_substitutions():
    for broken in itertools.combinations(range(own.STRETCH), 3):
        assert any(
            not any(at + place in broken for place in mask)
            for mask in own.MASKS
            for at in range(own.STRETCH - mask[-1])
        )


@pytest.mark.parametrize("bits", [24, 8])
def test_brute_force(spark, monkeypatch, bits):
    # With eight bits the field lets everything pass, and the join has to do all the work.
    monkeypatch.setattr(own, "_FIELD_BITS", bits)
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(5, 40)))) for i in range(10)]
    docs = []
    for number in range(80):
        words = draw.choices(vocabulary, k=draw.randint(0, 60))
        if number % 2:
            item = [draw.choice(vocabulary) if draw.random() < 0.18 else w for w in draw.choice(items)[1].split()]
            place = draw.randint(0, len(words))
            words = words[:place] + item[draw.randint(0, 3) :] + words[place:]
        docs.append((number, ", ".join(words).upper()))
    want = {(d, i): _brute(text.lower().replace(",", "").split(), item.split()) for d, text in docs for i, item in items}
    found = own.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    got = {(r.doc_id, r.item_id): (r.n_equal, -r.doc_word, -r.item_word) for r in found.collect()}
    assert got == {key: value for key, value in want.items() if value} and got


def test_masks_of_every_length_miss_no_stretch():
    for length in range(2, 16):
        for broken in itertools.combinations(range(length), length // 5):
            masks = own.FAMILIES.get(length) or [
                [at + place for place in mask] for mask in own.MASKS[:3] for at in range(length - mask[-1])
            ]
            assert any(not set(mask) & set(broken) for mask in masks)
    assert all(len(mask) >= min(length, 4) for length, family in own.FAMILIES.items() for mask in family)


def test_short_and_unspaced_items_and_those_without_an_id(spark):
    short = [" ".join(f"k{n}x{i}" for i in range(n)) for n in range(2, 13)]
    chinese, thai = "今天天气很好，我们去公园散步", "วันนี้อากาศดีมาก"
    items = [*enumerate(short, 2), (50, chinese), (51, thai), (None, "one item without any id at all"), (None, "another one that has no id"), (60, "first text of sixty"), (60, "second text of sixty")]
    docs, want = [], set()
    for item, text in items[:11]:
        words = text.split()
        for broken in itertools.combinations(range(item), item // 5):
            want.add((len(docs), item))
            docs.append((len(docs), " ".join(["aa", *("zz" if i in broken else w for i, w in enumerate(words)), "bb"])))
        docs.append((len(docs), " ".join("zz" if i <= item // 5 else w for i, w in enumerate(words))))
    for item, text in [(50, "他说" + chinese.replace("很", "不") + "。"), (51, "กก" + thai), (None, items[13][1]), (None, items[14][1]), (60, items[15][1]), (60, items[16][1])]:
        want.add((len(docs), item))
        docs.append((len(docs), text))
    found = own.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert sorted((r.doc_id, r.item_id or 0) for r in found.collect()) == sorted((d, i or 0) for d, i in want)


def test_planted_items_are_found_and_their_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = {(row.doc_id, row.item_id) for row in own.leaks(docs, items).collect()}
    texts = {row.item_id: row.text for row in items.collect()}
    planted = {(row.doc_id, i) for row in docs.collect() for i, text in texts.items() if text in row.text}
    assert planted and planted <= found
    left = own.without_leaks(docs, items)
    assert left.columns == docs.columns
    assert {row.doc_id for row in left.collect()} == {row.doc_id for row in docs.collect()} - {doc for doc, _ in found}


def test_rows_that_share_an_id(spark):
    item = " ".join(f"word{i}" for i in range(20))
    docs = [(1, f"{item} a b"), (1, f"{item.replace('word3 ', 'x ')} a b"), (1, "nothing here at all")]
    items = [(7, item), (8, item.replace("word3 ", "x "))]
    found = own.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert {(row.doc_id, row.item_id, row.n_equal) for row in found.collect()} == {(1, 7, 15), (1, 8, 15)}


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    items = [(1, None), (2, ""), (3, "too short"), (4, "the quick brown fox jumps over the lazy dog"), (4, "another"), (None, "x " * 20)]
    benchmark = spark.createDataFrame([(*row, "extra", 1) for row in items], ITEMS + ", seed string, doc_id int")
    assert {(row.doc_id, row.item_id) for row in own.leaks(docs, benchmark).collect()} == {(1, 4), (2, 4)}
    assert len(own.without_leaks(docs, benchmark).collect()) == len(awkward()) - 3
    assert own.leaks(docs, benchmark.limit(0)).count() == 0
    assert own.leaks(docs.limit(0), benchmark).count() == 0
