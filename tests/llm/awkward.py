"""Rows that every operator has to cope with."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "fp long, at int, key long, block long, part int, bucket long, verdict long, label int, score double, "
    "n_lines long, component long, lang_pred string, words string"
)
_EXTRA = (1, 2, 3, 4, 5, 6, 7, 8, 0.5, 9, 10, "xx", "zz")


def rows(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    langs = ("en", "de", None)
    return [(doc, text, langs[i % 3], "src" if i % 2 else None, len(text or ""), *_EXTRA) for i, (doc, text) in enumerate(texts)]


def awkward() -> list[tuple]:
    draw = random.Random(5)
    long_text = "\n".join(" ".join(draw.choice(("alpha", "beta", "gamma", "é", "ß")) for _ in range(12)) for _ in range(3000))
    long_word = "x" * 70_000 + " " + "ab" * 30_000
    texts = [
        (1, "The quick brown fox jumps over the lazy dog, twice.\nand\nagain"),
        (2, "The quick brown fox jumps over the lazy dog, twice.\nand\nagain"),
        (2, "The quick brown fox jumps over the lazy dog, twice.\nand\nagain"),
        (3, None),
        (4, ""),
        (5, " \n\t \r\n"),
        (6, "12345 67890 !!!"),
        (7, long_text),
        (8, long_text),
        (9, long_word),
        (10, "🙂🙂 日本語  テスト \u0000 end"),
        (None, "a row without an id"),
        (None, None),
        (11, "word " * 200),
        (11, "another text under the same id " * 5),
        (-7, "negative id"),
    ]
    return rows(texts)
