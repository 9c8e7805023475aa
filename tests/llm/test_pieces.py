from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm.pieces import PieceCoder, encode_documents, model_bytes

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return PieceCoder(model_bytes(PATH)), SentencePieceProcessor(model_file=PATH)


def _texts() -> list[str]:
    draw = random.Random(2)
    parts = ["a", "b", "th", "e", "ing", " ", "  ", "\n", "=", "-", "é", "Ü", "0", "日", "▁", "🙂", "ss", "\t", "</s>", "<0x0A>"]
    return [
        "", " ", "  a", "a  b ", "\n", "▁x", "aaaaaaaaaa", "=" * 1000, "\x00a", " " * 300, "﻿q", "\U0010ffff",
        *("".join(draw.choices(parts, k=draw.randint(1, 60))) for _ in range(600)),
    ]


def test_encodes_and_decodes_like_the_library(both):
    own, library = both
    texts = _texts()
    counts, ids, digests, decoded, kept = own.digests(texts, keep_ids=True)
    for text, count, digest, of_text, again, row in zip(texts, counts, ids, digests, decoded, kept, strict=True):
        want = library.encode(text)
        assert row.tolist() == want == own.encode(text)
        assert count == len(want)
        assert digest == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert again == library.decode(want) == own.decode(want)
        assert of_text == hashlib.sha256(again.encode()).hexdigest()


def test_decodes_bytes_that_form_no_character(both):
    own, library = both
    for ids in ([own.byte_ids[0xE6]], [own.byte_ids[0xE6], own.byte_ids[0x97], own.byte_ids[0xA5]], [own.byte_ids[0xFF], 450]):
        assert own.decode(ids) == library.decode(ids)


def test_awkward_rows(spark, both):
    _, library = both
    rows = awkward()
    found = encode_documents(spark.createDataFrame(rows, COLUMNS), PATH, keep_ids=True).collect()
    want = sorted((str(row[0]), len(library.encode(row[1] or ""))) for row in rows)
    assert sorted((str(row.doc_id), row.n_tokens) for row in found) == want
    assert encode_documents(spark.createDataFrame([], COLUMNS), PATH).count() == 0
