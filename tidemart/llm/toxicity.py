"""Toxicity by compression distance: how much better a dictionary of toxic text compresses a window of text.

The start of each word is written in capitals, the rest in lower case, and two zstandard dictionaries are
trained. The ordinary one comes from ordinary text. The toxic one comes
from those windows of toxic documents that the ordinary one compresses badly, in front of the same ordinary
text, so that common words cost alike under both. A text is cut at white space into windows of about 128
bytes, each is compressed with either dictionary, and the bytes that the toxic one saves are the distance of
the window. Ordinary windows with a saving are added to the ordinary dictionary and both are trained anew,
for a few rounds; the round that tells documents of a third, unused part of the sample apart best is kept.
On that part the thresholds are calibrated: a logistic unit over the largest saving of a document, the
sum, the number of windows that save, and the number of all windows.

Dictionaries are trained on the driver from a sample of bounded size: of the documents with the lowest hashes
of their ids `SAMPLE` toxic and `ORDINARY_SAMPLE` ordinary ones, as far as they have at most `SAMPLE_BYTES`
bytes. Scores read every window of
every whole text.

Defined results: a null or empty text has no window and gets the score of a text without any saving; a text
without white space is cut every 192 bytes; a text of any length is cut into windows, the largest distance
counts; of several texts under one id, the least one may be learned from; a document whose label rows
disagree counts as toxic, null labels and rows without an id are not learned from; without learned documents
of both labels every score is 0; ties between windows do not matter; repeated rows get equal scores; no
documents give no rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks, flat_bytes
from tidemart.llm.columns import named
from tidemart.llm.language import is_held_out

WINDOW = 128
SAMPLE = 2400
ORDINARY_SAMPLE = 4800
SAMPLE_BYTES = 20_000
ORDINARY_BYTES = 256 << 10
TOXIC_BYTES = 4 << 10
# Ordinary windows that one round adds to the ordinary dictionary, in bytes.
ADDED_BYTES = 64 << 10
ROUNDS = 8
# Saved bytes from which on a window counts.
SAVING = 1
THRESHOLD = 0.5

# Bytes at the start of a word that are written in capitals.
STEM = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[ord("a") : ord("z") + 1] -= 32

Windows = tuple[np.ndarray, np.ndarray, np.ndarray]


def cut_windows(flat: np.ndarray, offsets: np.ndarray) -> Windows:
    """Number of the text, start and end of each window; windows cover all bytes, texts without any have none."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    blanks = np.flatnonzero(flat <= 32)
    wanted = offsets[owner] + place * WINDOW
    following = np.r_[blanks, len(flat)][np.searchsorted(blanks, wanted)]
    starts = np.where(place == 0, wanted, np.minimum(following, wanted + WINDOW // 2))
    starts = np.minimum(starts, offsets[owner + 1])
    ends = np.r_[starts[1:], len(flat)]
    kept = ends > starts
    return owner[kept], starts[kept], ends[kept]


def marked(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lower case but for the start of each word, so that a stem differs from the same letters inside a word."""
    place = np.arange(len(flat))
    before = np.where(flat <= 32, place, -1)
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = np.where(flat[starts] <= 32, starts, starts - 1)
    in_word = place - np.maximum.accumulate(before)
    flat = _LOWER[flat]
    return np.where(in_word <= STEM, _UPPER[flat], flat)


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        window_log=22, chain_log=18, hash_log=18, search_log=4, min_match=4, target_length=8,
        strategy=zstandard.STRATEGY_LAZY, write_checksum=False, write_content_size=False, write_dict_id=False,
    )


class Compressor:
    """Lengths of windows under one dictionary."""

    def __init__(self, content: bytes) -> None:
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(compression_params=_parameters())
        self._compressor = zstandard.ZstdCompressor(compression_params=_parameters(), dict_data=own)

    def lengths(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.int64)
        segments = np.stack([starts, ends - starts], axis=1).astype("<u8")
        packed = zstandard.BufferWithSegments(flat.tobytes(), segments.tobytes())
        found = self._compressor.multi_compress_to_buffer(packed)
        return np.fromiter((len(window) for window in found), np.int64, len(starts))


def train_dictionary(windows: list[bytes], size: int) -> bytes:
    """Content for a dictionary; of texts too few to be trained on, their last bytes."""
    try:
        return zstandard.train_dictionary(size, windows, k=16, d=6, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(windows)[-size:]


@dataclass
class Texts:
    """Texts with marked words in one array, and their windows."""

    flat: np.ndarray
    windows: Windows
    count: int

    @classmethod
    def of(cls, flat: np.ndarray, offsets: np.ndarray) -> Texts:
        flat = marked(flat, offsets)
        return cls(flat, cut_windows(flat, offsets), len(offsets) - 1)

    @classmethod
    def join(cls, texts: list[bytes]) -> Texts:
        return cls.of(np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(text) for text in texts])].astype(np.int64))

    def lengths(self, compressor: Compressor) -> np.ndarray:
        return compressor.lengths(self.flat, *self.windows[1:])

    def cut(self, chosen: np.ndarray) -> list[bytes]:
        raw, (_, starts, ends) = self.flat.tobytes(), self.windows
        return [raw[starts[i] : ends[i]] for i in chosen]

    def features(self, savings: np.ndarray) -> np.ndarray:
        """What a document is judged by: largest saving, sum, windows that save, share of them, all windows."""
        owner = self.windows[0]
        savings = np.maximum(savings, 0)
        most = np.zeros(self.count)
        np.maximum.at(most, owner, savings)
        total = np.bincount(owner, savings, self.count)
        saving = np.bincount(owner, savings >= SAVING, self.count)
        windows = np.bincount(owner, minlength=self.count)
        share = saving / np.maximum(windows, 1)
        columns = [np.minimum(most, 12) / 4, most >= SAVING, np.log1p(total), np.log1p(saving), share, np.log1p(windows) / 4]
        return np.stack(columns, axis=1).astype(float)


@dataclass
class Logistic:
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 30, shrink: float = 0.05) -> Logistic:
        """Newton's method; every label weighs what it weighs in the sample."""
        x = np.c_[x, np.ones(len(x))]
        weights = np.zeros(x.shape[1])
        for _ in range(steps):
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = x.T @ (score - y) + shrink * weights
            bend = (x * (score * (1 - score))[:, None]).T @ x + shrink * np.eye(len(weights))
            weights = weights - np.linalg.solve(bend, slope)
        return cls(weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.weights, -30, 30)))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    unit: Logistic | None = None

    def compressors(self) -> tuple[Compressor, Compressor]:
        return Compressor(self.ordinary), Compressor(self.toxic + self.ordinary)


def _savings(texts: Texts, compressors: tuple[Compressor, Compressor]) -> np.ndarray:
    ordinary, toxic = compressors
    return texts.lengths(ordinary) - texts.lengths(toxic)


def learn(toxic: list[bytes], ordinary: list[bytes], rounds: int = ROUNDS) -> Model | None:
    """Train both dictionaries and calibrate on texts that neither has seen; None without both labels."""
    if len(toxic) < 3 or len(ordinary) < 3:
        return None
    parts = [(Texts.join(toxic[i::3]), Texts.join(ordinary[i::3])) for i in range(3)]
    (toxic_one, ordinary_one), (toxic_two, ordinary_two), (toxic_last, ordinary_last) = parts
    label = np.r_[np.ones(toxic_last.count), np.zeros(ordinary_last.count)]
    base = train_dictionary(ordinary_one.cut(np.arange(len(ordinary_one.windows[0]))), ORDINARY_BYTES)
    # Windows that ordinary text explains least.
    lengths = toxic_one.lengths(Compressor(base))
    novel = np.flatnonzero(lengths >= np.quantile(lengths, 0.7)) if len(lengths) else np.zeros(0, np.int64)
    model = Model(base, train_dictionary(toxic_one.cut(novel), TOXIC_BYTES))
    best, least = None, np.inf
    for _ in range(rounds + 1):
        pair = model.compressors()
        seen = [_savings(texts, pair) for texts in (toxic_last, ordinary_last)]
        x = np.r_[toxic_last.features(seen[0]), ordinary_last.features(seen[1])]
        unit = Logistic.fit(x, label)
        score = np.clip(unit.score(x), 1e-6, 1 - 1e-6)
        loss = -(label * np.log(score) + (1 - label) * np.log(1 - score)).mean()
        if loss < least:
            best, least = Model(model.ordinary, model.toxic, unit), loss
        wrong = _savings(ordinary_two, pair)
        order = np.argsort(-wrong, kind="stable")
        added = b"".join(ordinary_two.cut(order[wrong[order] > SAVING]))[:ADDED_BYTES]
        again = [texts.cut(np.flatnonzero(_savings(texts, pair) > SAVING)) for texts in (toxic_one, toxic_two)]
        model = Model(model.ordinary + added, train_dictionary(again[0] + again[1], TOXIC_BYTES))
    return best


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, ordinary: int = ORDINARY_SAMPLE
) -> Model | None:
    """Learn from documents with labels (doc_id, label 0 or 1)."""
    known = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64(F.lit("toxicity sample"), "doc_id"), "doc_id"]
    drawn = [known.where(F.col("label") == label).orderBy(*order).limit(rows) for label, rows in ((0, ordinary), (1, sample))]
    # At most `sample` and `ordinary` rows of two numbers.
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    texts = named(docs, "doc_id", "text").where(F.octet_length("text").between(1, SAMPLE_BYTES))
    # One text for each id, however many rows share it.
    rows = texts.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).toArrow()
    listed = sorted(zip(rows.column("doc_id").to_pylist(), rows.column("label").to_pylist(), rows.column("text").to_pylist()))
    by_label = [[text.encode() for _, known, text in listed if known == label] for label in (0, 1)]
    return learn(by_label[1], by_label[0])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None
        for batch in blocks(batches):
            score = np.zeros(batch.num_rows)
            if model is not None:
                pair = pair or model.compressors()
                texts = Texts.of(*flat_bytes(batch))
                score = model.unit.score(texts.features(_savings(texts, pair)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return named(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Learn `toxic` outside the fold and score all documents: doc_id, held_out, score, predicted."""
    held_out = is_held_out(F.col("doc_id"), folds, fold)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    model = train(docs, known.where(~held_out))
    return predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
