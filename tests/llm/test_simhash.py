from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm import simhash as own
from tidemart.llm.components import roots


def _fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _components(ids: list[int], points: list[int]) -> dict[int, int]:
    values, parent = np.array(points, np.uint64), {i: i for i in ids}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= 4):
            one, two = find(ids[i]), find(ids[j])
            parent[max(one, two)] = min(one, two)
    return {i: find(i) for i in ids}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    points = [_fingerprint(row.text) for row in rows]
    want = _components([row.doc_id for row in rows], points)
    found = {row.doc_id: row for row in own.near_duplicates(docs).collect()}
    assert {k: int(row.fingerprint, 16) for k, row in found.items()} == {r.doc_id: p for r, p in zip(rows, points, strict=True)}
    assert {k: row.component_id for k, row in found.items()} == want


@pytest.mark.parametrize("block", [4096, 40])
def test_all_links_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(own, "BLOCK", block)
    draw, points = random.Random(5), set()
    for _ in range(60):
        center = draw.getrandbits(64)
        for _ in range(25):
            point = center
            for _ in range(draw.randint(0, 9)):
                point ^= 1 << draw.randrange(64)
            points.add(point)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(points)]
    links = own.links_between(spark.createDataFrame([(p,) for p in signed], "fp long"))
    assert links.count() <= 3 * 24 * len(points)
    found = {row.node: row.root for row in roots(links).collect()}
    want = _components(signed, [p % (1 << 64) for p in signed])
    assert {p: found.get(p, p) for p in signed} == want


def test_anchors_cover_all_words():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    at, home = own.anchors_of(words, 23, 0)
    assert (at == np.arange(2000)).all() and (np.bitwise_count(home ^ words) <= 3).all()
    assert (own._remainder(home) == 0).all()
    at, near = own.anchors_of(words, 23, 1)
    assert (np.bitwise_count(near ^ words[at]) <= 4).all() and (own._remainder(near) == 0).all()
    messages = np.arange(1 << 12) << 11
    code = messages ^ own._remainder(messages)
    for place in range(0, 2000, 100):
        within = code[np.bitwise_count(code ^ words[place]) <= 4]
        assert sorted(near[at == place]) == sorted(within)


def test_chains_and_stars_become_components(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 500)]
    found = {row.node: row.root for row in roots(spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(500)}
    assert roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    found = own.near_duplicates(docs).collect()
    assert len(found) == len(awkward())
    by_id = {row.doc_id: row for row in found}
    assert by_id[3].fingerprint == "0" * 16 and by_id[4].component_id == by_id[5].component_id == 3
    assert by_id[2].component_id == 1 and by_id[8].component_id == 7
    kept = own.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-7, 1, 3, 6, 7, 9, 10, 11] and ids.count(None) == 2
    assert own.near_duplicates(spark.createDataFrame([], COLUMNS)).count() == 0
