from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemart.llm import negatives as own

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """Everything by the words of the definition; rows are (vec_id, embedding, label)."""
    least = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        x = [float(np.float32(v)) for v in x]
        least[vec_id] = min(least.get(vec_id, (label, x)), (label, x))
    known = {
        vec_id: ((label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * v) for v in x])
        for vec_id, (label, x) in least.items()
    }
    found = set()
    for anchor in [vec_id for vec_id in known if vec_id % 50 == 0]:
        label, x = known[anchor]
        others = sorted(
            (-sum(a * b for a, b in zip(x, y)), row, other == label) for row, (other, y) in known.items() if row != anchor
        )
        for score, positive, _ in [other for other in others if other[2]][:5]:
            fit = [(row, s) for s, row, same in others if not same and 50 * -score <= 100 * -s <= 95 * -score]
            found |= {(anchor, positive, rank, row, -score, -s) for rank, (row, s) in enumerate(fit[:3], 1)}
    return found


def mined(spark, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(row) for row in own.mine(frame, **settings).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("anchor_bytes", [own.ANCHOR_BYTES, 200])
def test_equals_the_definition(spark, anchor_bytes):
    draw = random.Random(1)
    # Coarse components, so that scores tie.
    rows = [(i, [draw.choice((-0.5, 0.0, 0.25, 0.5, 0.75)) for _ in range(6)], draw.randrange(3)) for i in range(-200, 700)]
    wanted = plain(rows)
    assert len(wanted) > 150 and mined(spark, rows, anchor_bytes=anchor_bytes) == wanted


def test_small_blocks_of_rows_lose_nothing(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(4)], draw.randrange(10)) for i in range(600)]
    # A third of all rows is one vector under one label.
    rows += [(i, [0.3, 0.3, 0.3, 0.3], 4) for i in range(600, 900)]
    assert mined(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (0, [0.5, 0.5], 2), (1, [1.0, 1.0], 1), (2, [0.6, 0.6], 3),
        (2, [0.6, 0.6], 3), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (None, [1.0, 1.0], 3), (8, [1.0, 1.0], None), (9, [0.9], 3), (10, [0.7, 0.7, 0.7], 4), (11, [], 3),
        (50, [0.0, 0.0], 1), (51, [0.0, 0.0], 1), (53, [0.0, 0.0], 3), (-50, [-1.0, -1.0], 2), (100, [], 3),
    ]
    found = mined(spark, rows)
    assert found == plain(rows) and any(row[4] == 0 for row in found)
    assert mined(spark, [row for row in rows if row[0] != 0 and (row[0] or 1) % 50]) == set()
    assert mined(spark, []) == set()
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "'x' AS positive", "2 AS x", "3 AS least")
    assert {tuple(row) for row in own.mine(extra).collect()} == found


def test_negatives_of_score_zero_before_and_after_their_positive():
    keys = [(own.pack(0, 0, 3), False), (own.pack(0, 0, 4), True), (own.pack(0, 0, 5), False), (own.pack(0, 0, 6), False)]
    keys += [(own.pack(0, 0, 7), False), (own.pack(0, -1, 1), False)]
    got = [(row[1], row[2], row[3]) for row in own.stream_negatives(iter(keys))]
    assert got == [(4, 1, 3), (4, 2, 5), (4, 3, 6)]


def test_keys_sort_as_wanted():
    draw = random.Random(4)
    triples = [(draw.choice((-(2**63), -50, 0, 2**62)), draw.choice((-(2**62), -1, 0, 1, 2**62)), draw.randrange(-(2**63), 2**63)) for _ in range(300)]
    assert [own.unpack(own.pack(*triple)) for triple in triples] == triples
    assert sorted(triples, key=lambda t: (t[0], -t[1], t[2])) == sorted(triples, key=lambda t: own.pack(*t))


def test_large_components_are_multiplied_exactly():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20 + 1, 5.0], [2.0**60, 0.0], [-(2.0**60), 0.0]])
    assert own.scores(a, b).tolist() == [[2**60 + 2**40 + 15, 2**62, -(2**62)]]
    assert own.scores(a, np.zeros((2, 0))).tolist() == [[0, 0]]
