from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm import toxicity as own


def packed(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(text) for text in texts])].astype(np.int64)


def test_windows_cover_every_byte_once_and_cut_at_blanks():
    draw = random.Random(1)
    texts = [b"", b"one", b"x" * 1000, b" ", b"a b " * 200]
    texts += [b" ".join(b"w" * draw.randrange(1, 20) for _ in range(draw.randrange(200))) for _ in range(50)]
    flat, offsets = packed(texts)
    owner, starts, ends = own.cut_windows(flat, offsets)
    assert (starts[1:] == ends[:-1]).all() and starts[0] == 0 and ends[-1] == len(flat)
    assert (offsets[owner] <= starts).all() and (ends <= offsets[owner + 1]).all()
    assert (ends - starts).max() <= own.WINDOW * 3 // 2 and (ends - starts).min() > 0
    inside = starts[(starts > offsets[owner]) & (owner != 2)]
    assert (flat[inside] == ord(" ")).all()


def test_marked_words_by_a_plain_loop():
    texts = [b"Hello wOrld", b"", b"ab", b" x  YZ\nlonger", "é héhéhé".encode(), b"tail"]

    def plain(text):
        out, place = bytearray(), 0
        for byte in text.lower():
            place = 0 if byte <= 32 else place + 1
            out += bytes([byte]).upper() if 1 <= place <= own.STEM else bytes([byte])
        return bytes(out)

    assert own.marked(*packed(texts)).tobytes() == b"".join(plain(text) for text in texts)


def test_lengths_are_those_of_single_compressions():
    import zstandard

    draw = random.Random(2)
    texts = [b" ".join(draw.choice((b"alpha", b"beta", b"gamma", b"delta")) for _ in range(60)) for _ in range(5)]
    flat, offsets = packed(texts)
    _, starts, ends = own.cut_windows(flat, offsets)
    content = b"alpha beta gamma delta alpha gamma beta delta"
    single = zstandard.ZstdCompressor(
        compression_params=own._parameters(),
        dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
    )
    wanted = [len(single.compress(flat[a:b].tobytes())) for a, b in zip(starts, ends, strict=True)]
    assert own.Compressor(content).lengths(flat, starts, ends).tolist() == wanted


def test_planted_words_are_learned_and_found_anywhere_in_long_texts():
    draw = random.Random(3)
    parts = [a + b for a in ("ba", "ko", "mi", "tu", "sel", "ron", "pa", "li") for b in ("", "na", "dor", "es")]

    def text(words, *planted):
        listed = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 3))) for _ in range(words)]
        for word in planted:
            listed.insert(draw.randrange(len(listed)), word)
        return " ".join(listed).encode()

    def bad(words):
        return text(words, *draw.sample(("wretched", "vermin", "dimwit", "halfbrain"), 2))

    sizes = (60, 150, 1000)
    model = own.learn([bad(draw.choice(sizes)) for _ in range(300)], [text(draw.choice(sizes)) for _ in range(600)])
    held = own.Texts.join([bad(draw.choice((60, 3000))) for _ in range(100)] + [text(draw.choice((60, 3000))) for _ in range(200)])
    found = model.unit.score(held.features(own._savings(held, model.compressors()))) >= 0.5
    assert found[:100].mean() >= 0.9 and found[100:].mean() <= 0.05


@pytest.mark.parametrize("toxic, ordinary", [([], [b"a"] * 5), ([b"a"] * 5, []), ([b"x"] * 3, [b"y"] * 3), ([b""] * 4, [b""] * 4)])
def test_small_samples(toxic, ordinary):
    model = own.learn(toxic, ordinary)
    assert (model is None) == (min(len(toxic), len(ordinary)) < 3)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = own.score_toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    found = [row for row in rows if row.predicted]
    # The stems of other languages have some fifty documents to be learned from here.
    english = [row for row in rows if row.toxic and row.lang == "en"]
    assert len(rows) > 500 and sum(row.predicted for row in english) >= 0.8 * len(english) > 30
    assert sum(row.toxic for row in found) >= 0.9 * len(found)
    assert all(row.predicted == int(row.score >= 0.5) for row in rows)


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    labels = [(1, 1), (2, 0), (2, 1), (3, None), (4, 0), (None, 1), (7, 1), (99, 0), (9, 1), (6, 0), (11, 1), (10, 0), (5, 0), (-7, 0)]
    labels = spark.createDataFrame([(*row, 5, "x") for row in labels], "doc_id int, toxic int, score int, text string")
    found = own.score_toxicity(docs, labels).collect()
    assert len(found) == len(awkward()) and all(0 <= row.score <= 1 for row in found)
    for doc in (1, 2, 8):
        assert len({row.score for row in found if row.doc_id == doc}) <= 1
    assert {row.score for row in own.score_toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {row.score for row in own.score_toxicity(docs, labels.where("toxic = 1")).collect()} == {0.0}
    assert own.score_toxicity(docs.limit(0), labels).count() == 0
