"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages of 512 bytes. Each passage is described by the shares of byte classes in
it and by its words (lengths, distinct ones, words that repeat the one before), and encoded by one learned
layer. Gated attention (a tanh branch times a sigmoid branch) gives every passage a weight, the
weighted sum of the codes represents the document, and a logistic unit scores it. All weights are
learned together from the labels of documents; passages have no labels.

The network is fitted on the driver to a sample of bounded size: `SAMPLE` labelled documents with the
lowest hashes of their ids, of at most `SAMPLE_BYTES` bytes each. Scores read every passage of every
whole text.

Defined results: a null or empty text is one passage without bytes and is scored like any other; a document
whose label rows disagree counts as low quality; without labels every score is 0.5; repeated
rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks, flat_bytes
from tidemart.llm.columns import named
from tidemart.llm.language import is_held_out
from tidemart.llm.words import BLANK, split_words, word_hashes

PASSAGE = 512
SAMPLE = 6000
SAMPLE_BYTES = 100_000
THRESHOLD = 0.3

# Classes of bytes: lower case, upper case, digits, blanks, line ends, bytes of other characters, and
# each punctuation mark for itself.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASSES = 7 + len(_MARKS)
_CLASS = np.full(256, 6)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[ord(" ")] = 3
_CLASS[ord("\n")] = 4
_CLASS[128:] = 5
for _number, _mark in enumerate(_MARKS):
    _CLASS[ord(_mark)] = 7 + _number
FEATURES = _CLASSES + 5


def passages(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the n + 1 offsets of the texts among them."""
    lengths = np.diff(offsets)
    bags = np.r_[0, np.cumsum(np.maximum(1, -(-lengths // PASSAGE)))]
    total = int(bags[-1])
    features = np.zeros((total, FEATURES), np.float32)
    if not len(flat):
        return features, bags
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = bags[owner] + (np.arange(len(flat)) - offsets[owner]) // PASSAGE
    shares = np.bincount(place * _CLASSES + _CLASS[flat], minlength=total * _CLASSES)
    size = np.bincount(place, minlength=total)
    features[:, :_CLASSES] = np.sqrt(shares.reshape(total, _CLASSES) / np.maximum(size, 1)[:, None])
    starts, ends, _ = split_words(flat, offsets, BLANK)
    if len(starts):
        at, width = place[starts], ends - starts
        words = np.maximum(np.bincount(at, minlength=total), 1)
        hashes = word_hashes(flat, starts, ends)
        mean = np.bincount(at, width, total) / words
        spread = np.sqrt(np.maximum(np.bincount(at, width.astype(float) ** 2, total) / words - mean**2, 0))
        distinct = np.unique((at.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        kinds = np.bincount((distinct >> np.uint64(40)).astype(np.int64), minlength=total)
        again = np.r_[False, (hashes[1:] == hashes[:-1]) & (at[1:] == at[:-1])]
        features[:, _CLASSES] = np.log1p(mean)
        features[:, _CLASSES + 1] = np.log1p(spread)
        features[:, _CLASSES + 2] = kinds / words
        features[:, _CLASSES + 3] = np.bincount(at, again, total) / words
    features[:, _CLASSES + 4] = np.log1p(size)
    return features, bags


@dataclass
class AttentionNet:
    """Encoder, gated attention and scoring unit, trained by gradient descent (Adam)."""

    code: int = 24
    gate: int = 12
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = 40, seed: int = 7) -> AttentionNet:
        random = np.random.default_rng(seed)
        self.shift, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        shapes = {
            "E": (x.shape[1], self.code), "e": (self.code,), "V": (self.code, self.gate), "U": (self.code, self.gate),
            "a": (self.gate,), "w": (self.code,), "b": (1,),
        }
        self.weights = {
            name: random.normal(0, shape[0] ** -0.5, shape) if len(shape) > 1 or name in "aw" else np.zeros(shape)
            for name, shape in shapes.items()
        }
        first = {name: np.zeros_like(value) for name, value in self.weights.items()}
        second = {name: np.zeros_like(value) for name, value in self.weights.items()}
        x, step = self._scaled(x), 0
        for _ in range(epochs):
            order = random.permutation(len(y))
            for start in range(0, len(y), 64):
                chosen = order[start : start + 64]
                sizes = bags[chosen + 1] - bags[chosen]
                own = np.r_[0, np.cumsum(sizes)]
                rows = np.repeat(bags[chosen] - own[:-1], sizes) + np.arange(own[-1])
                slopes = self._slopes(x[rows], own, y[chosen])
                step += 1
                for name, slope in slopes.items():
                    slope = slope + 1e-4 * self.weights[name]
                    first[name] += 0.1 * (slope - first[name])
                    second[name] += 0.001 * (slope**2 - second[name])
                    rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[name] -= rate * first[name] / (np.sqrt(second[name]) + 1e-8)
        return self

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.shift) / self.scale, -8, 8)

    def _forward(self, x: np.ndarray, bags: np.ndarray):
        w = self.weights
        sizes = np.diff(bags)
        codes = np.tanh(x @ w["E"] + w["e"])
        value, gate = np.tanh(codes @ w["V"]), 1 / (1 + np.exp(-(codes @ w["U"])))
        logit = (value * gate) @ w["a"]
        logit = np.exp(logit - np.repeat(np.maximum.reduceat(logit, bags[:-1]), sizes))
        attention = logit / np.repeat(np.add.reduceat(logit, bags[:-1]), sizes)
        document = np.add.reduceat(attention[:, None] * codes, bags[:-1])
        score = 1 / (1 + np.exp(-np.clip(document @ w["w"] + w["b"], -40, 40)))
        return codes, value, gate, attention, document, score

    def _slopes(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, sizes = self.weights, np.diff(bags)
        codes, value, gate, attention, document, score = self._forward(x, bags)
        error = (score - y) / len(y)
        to_document = np.repeat(error[:, None] * w["w"], sizes, axis=0)
        to_attention = (to_document * codes).sum(axis=1)
        mean = np.repeat(np.add.reduceat(attention * to_attention, bags[:-1]), sizes)
        to_logit = (attention * (to_attention - mean))[:, None]
        to_value = to_logit * w["a"] * gate * (1 - value**2)
        to_gate = to_logit * w["a"] * value * gate * (1 - gate)
        to_codes = attention[:, None] * to_document + to_value @ w["V"].T + to_gate @ w["U"].T
        to_input = to_codes * (1 - codes**2)
        return {
            "E": x.T @ to_input, "e": to_input.sum(axis=0), "V": codes.T @ to_value, "U": codes.T @ to_gate,
            "a": (to_logit * value * gate).sum(axis=0), "w": document.T @ error, "b": np.array([error.sum()]),
        }

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        return self._forward(self._scaled(x), bags)[-1]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        features, bags = passages(*flat_bytes(batch))
        rows = pa.ListArray.from_arrays((bags * FEATURES).astype(np.int32), features.ravel())
        yield pa.RecordBatch.from_arrays([batch.column("label"), rows], ["label", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionNet | None:
    """Fit to labelled documents; labels has doc_id and label (0 or 1)."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").cast("double").alias("label"))
        .orderBy(F.xxhash64(F.lit("quality sample"), "doc_id"), "doc_id")
        .limit(sample)
    )
    # At most `sample` rows of two numbers.
    texts = named(docs, "doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("text", "label")
        .mapInArrow(_described, "label double, x array<float>")
        .toArrow()
    )
    y = np.array(rows.column("label").to_pylist(), float)
    if not len(y):
        return None
    lists = [value.values.to_numpy(zero_copy_only=False) for value in rows.column("x")]
    bags = np.r_[0, np.cumsum([len(value) // FEATURES for value in lists])]
    x = np.concatenate(lists).reshape(-1, FEATURES)
    # The order of rows must not depend on how tasks were dealt.
    order = np.lexsort((x[bags[:-1], -1], x[bags[:-1], 0], np.diff(bags), y))
    rows_of = np.concatenate([np.arange(bags[i], bags[i + 1]) for i in order])
    sizes = np.diff(bags)[order]
    return AttentionNet().fit(x[rows_of].astype(float), np.r_[0, np.cumsum(sizes)], y[order])


def predict(docs: DataFrame, net: AttentionNet | None) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            score = np.full(batch.num_rows, 0.5)
            if net is not None:
                features, bags = passages(*flat_bytes(batch))
                score = net.score(features, bags)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return named(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Learn `quality` outside the fold and score all documents: doc_id, held_out, score, predicted."""
    held_out = is_held_out(F.col("doc_id"), folds, fold)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    net = train(docs, known.where(~held_out))
    return predict(docs, net).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
