from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemart.llm import conversations as own
from tidemart.llm.centroids import subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_key(row):
    role, text = row[2] or "", row[3] or ""
    return row[1] is not None, row[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    """The rows of the trie by the words of the contract."""
    convs = {}
    for row in sorted((row for row in rows if row[0] is not None), key=lambda row: (row[0], *turn_key(row))):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    built = {}
    for conv, turns in convs.items():
        taken = zlib.crc32(str(conv).encode()) % 6
        head = convs.get(conv - int(np.fmod(conv, 100)), [])[:taken]
        built[conv] = (*head, *turns[taken:])
    members, children = {}, {}
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
            if depth:
                children.setdefault(turns[: depth - 1], set()).add(turns[:depth])
    found = []
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[child] for child in children.get(node, ())]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
        ends = ",".join(str(conv) for conv in sorted(members[node]) if len(built[conv]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        found.append(
            (min(members[node]), len(node), parent, len(members[node]), len(children.get(node, ())), *sums[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=lambda row: (row[0], row[1]))


def trie(spark, rows, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted((tuple(row) for row in own.prefix_trie(frame, **settings).collect()), key=lambda row: (row[0], row[1]))


def conversations(draw, count):
    rows = []
    for conv in range(-120, count):
        for turn in range(draw.choice((1, 2, 3, 8))):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], draw.choice("ab") * draw.randrange(1, 3)))
    return rows


@pytest.mark.parametrize("rolled, block", [(256, 4096), (16, 3)])
def test_equals_the_contract(spark, rolled, block):
    draw = random.Random(1)
    # One conversation is far longer than the others, one has a copy, one is missing at the head of its family.
    rows = [row for row in conversations(draw, 260) if row[0] != 100]
    rows += [(207, turn, "user", str(turn)) for turn in range(8, 90)]
    rows += [(208, turn, "user", str(turn)) for turn in range(8, 60)]
    wanted = plain(rows)
    assert len(wanted) > 300 and trie(spark, rows, rolled=rolled, block=block) == wanted


def test_awkward_rows(spark):
    rows = [
        (0, 1, "user", "hi"), (0, None, None, None), (0, None, "", ""), (0, 2, "user", "é🙂"), (0, 2, "a", "x"), (0, 2, "a", "x"),
        (None, 0, "user", "no id"), (1, 0, "user:", "a"), (1, 1, "user", ":a"), (3, 5, "user", "y" * 100_000), (250, 0, "u", "t"),
        (251, 0, "u", "t"), (252, 0, "u", "t"), (-5, 0, "u", "t"), (-105, 3, None, "t\u0000"),
    ]
    assert trie(spark, rows, rolled=4, block=2) == plain(rows)
    assert trie(spark, []) == []
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "'x' AS place", "2 AS depth", "3 AS seq", "4 AS digest")
    got = sorted((tuple(row) for row in own.prefix_trie(extra).collect()), key=lambda row: (row[0], row[1]))
    assert got == plain(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "forest", "caterpillar"])
def test_subtree_sums(shape):
    draw = np.random.default_rng(3)
    n = 700
    up = {
        "chain": np.maximum(np.arange(n) - 1, 0),
        "star": np.zeros(n, int),
        "random": np.r_[0, [draw.integers(0, i) for i in range(1, n)]],
        "forest": np.array([i if i < 20 else draw.integers(0, i) for i in range(n)]),
        "caterpillar": np.array([max(0, i - 2 if i % 2 == 0 else i - 1) for i in range(n)]),
    }[shape]
    own_weight, values = draw.integers(1, 9, n), draw.integers(-50, 50, (2, n))
    wanted, weight = values.copy(), own_weight.copy()
    for i in range(n - 1, -1, -1):
        if up[i] != i:
            wanted[:, up[i]] += wanted[:, i]
            weight[up[i]] += weight[i]
    shuffled = draw.permutation(n)
    place = np.argsort(shuffled)
    got = subtree_sums(place[up[shuffled]], weight[shuffled], values[:, shuffled])
    assert (got == wanted[:, shuffled]).all()


def test_long_lists_of_ends_are_hashed_in_chunks(spark, monkeypatch):
    rows = [(conv, 0, "u", "same") for conv in range(2000) if zlib.crc32(str(conv).encode()) % 6 == 0]
    monkeypatch.setattr(own, "CHUNK", 100)
    assert trie(spark, rows) == plain(rows)
