from __future__ import annotations

import numpy as np

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm import quality as own


def test_slopes_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    x, bags, y = draw.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    net = own.AttentionNet(code=4, gate=3).fit(x, bags, y, epochs=1)

    def loss() -> float:
        score = net._forward(x, bags)[-1]
        return float(-(y * np.log(score) + (1 - y) * np.log(1 - score)).mean())

    slopes = net._slopes(x, bags, y)
    for name, weights in net.weights.items():
        for at in np.ndindex(weights.shape):
            kept = weights[at]
            weights[at] = kept + 1e-6
            above = loss()
            weights[at] = kept - 1e-6
            below = loss()
            weights[at] = kept
            assert abs((above - below) / 2e-6 - slopes[name][at]) < 1e-6


def test_attention_finds_the_telling_passage():
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 9, 400)
    bags = np.r_[0, np.cumsum(sizes)]
    x = draw.normal(size=(bags[-1], 6))
    y = (draw.random(400) < 0.5).astype(float)
    for bag in np.flatnonzero(y):
        x[draw.integers(bags[bag], bags[bag + 1]), 0] += 6
    net = own.AttentionNet().fit(x, bags, y, epochs=60)
    assert ((net.score(x, bags) > 0.5) == y).mean() > 0.95


def test_passages_cover_whole_texts():
    texts = [b"", b"Ab 1!\n", b"x" * 1300, "é ".encode() * 300]
    flat, offsets = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
    features, bags = own.passages(flat, offsets)
    assert np.diff(bags).tolist() == [1, 1, 3, 2]
    assert (features[0] == 0).all() and np.isclose((features[1, : own._CLASSES] ** 2).sum(), 1)
    assert np.allclose(np.expm1(features[:, -1]), [0, 6, 512, 512, 276, 512, 388])


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = own.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(row.predicted == row.quality for row in rows) >= 0.97 * len(rows) > 500
    low = [row for row in rows if row.quality == 0]
    assert sum(row.predicted == 0 for row in low) >= 0.95 * len(low)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    labels = [(1, 1), (2, 0), (2, 1), (3, None), (4, 0), (None, 1), (7, 1), (99, 0), (9, 1), (6, 0)]
    labels = spark.createDataFrame([(*row, 5, "x") for row in labels], "doc_id int, quality int, score int, text string")
    found = own.score_quality(docs, labels).collect()
    assert len(found) == len(awkward()) and all(0 <= row.score <= 1 for row in found)
    assert all(row.predicted == int(row.score >= 0.3) for row in found)
    assert {row.score for row in own.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert own.score_quality(docs.limit(0), labels).count() == 0
