"""Secret scan: candidates by their form, false positives removed by a random forest.

A candidate is an unbroken run of 16 or more letters, digits and _ + / - characters (ASCII) that no other word
character touches. It is described by its length, the changes between kinds of characters in it,
how many of its three-letter pieces the corpus uses (dictionary coverage), the words and signs
around it, and the path it was found under. A random forest trained on labelled findings decides
which candidates are secrets.

The dictionary counts three-letter pieces over all documents; each task adds up its own counts in a
table of fixed size. Labelled findings can be given. Where there are none, all candidates are labelled
by the strict published formats of keys (`SIGNATURES`) together with what stands before them; the forest
sees features only. It learns from a sample of bounded size: of each label the `SAMPLE` different
candidates (by secret and features, so copies count once) with the lowest hashes. Both labels weigh the same
in training, however rare one is.

Defined results: null and empty texts have no candidates; every occurrence of a secret is a finding of its
own; rows that share an id and a text repeat their findings; a null path is an empty one; if
the labels are all alike, every candidate gets that label.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks, flat_bytes, texts_of
from tidemart.session import checkpointed

SAMPLE = 20_000
TREES = 20
DEPTH = 8
CANDIDATE = re.compile(r"(?<![\w+/\-])[A-Za-z0-9_+/\-]{16,}(?![\w+/\-])")
# Published forms of keys. The second part says what has to stand before the candidate.
SIGNATURES = (
    (re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}"), re.compile("")),
    (re.compile(r"gh[pousr]_[0-9A-Za-z]{36}"), re.compile("")),
    (re.compile(r"[0-9a-f]{16,}"), re.compile(r"(?i)(token|password|secret|key)\s*[=:]\s*[\"']?$")),
    (re.compile(r"[0-9A-Za-z+/_\-]{20,}"), re.compile(r"(?i)(token|password|secret|key)\s*[=:]\s*[\"']$")),
)
_BEFORE = 40
# Letters, then one class for bytes of other characters and one for everything else.
_LETTERS = 28
_LETTER = np.full(256, 27)
for _code in range(26):
    _LETTER[ord("a") + _code] = _LETTER[ord("A") + _code] = _code
_LETTER[128:] = 26
_WORD_BUCKETS = 24
_PATH_BUCKETS = 8
FEATURES = 14 + 2 * _WORD_BUCKETS + _PATH_BUCKETS


def _pieces(flat: np.ndarray) -> np.ndarray:
    letters = _LETTER[flat]
    return (letters[:-2] * _LETTERS + letters[1:-1]) * _LETTERS + letters[2:]


def fragment_counts(docs: DataFrame) -> np.ndarray:
    """How often each three-letter piece occurs in all documents; a table of 28^3 counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_LETTERS**3, np.int64)
        for batch in blocks(batches):
            flat, offsets = flat_bytes(batch)
            inner = np.ones(max(0, len(flat) - 2), bool)
            for back in (1, 2):
                ends = offsets[1:] - back
                inner[ends[(ends >= 0) & (ends < len(inner))]] = False
            counts += np.bincount(_pieces(flat)[inner], minlength=len(counts)) if len(inner) else 0
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["piece", "n"])

    rows = (
        docs.select(F.col("text").cast("string").alias("text"))
        .where("text IS NOT NULL")
        .mapInArrow(run, "piece long, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(_LETTERS**3, np.int64)
    for row in rows:
        counts[row["piece"]] = row["n"]
    return counts


def _bucket(word: str, buckets: int) -> int:
    return int.from_bytes(hashlib.blake2b(word.lower().encode(), digest_size=4).digest(), "big") % buckets


_NEAR_BEFORE = re.compile(r"(\w+)\W*$")
_NEAR_AFTER = re.compile(r"\W*(\w+)")


def features(candidate: str, before: str, after: str, path: str, common: np.ndarray) -> list[float]:
    """What the forest sees of one candidate. `common` marks the pieces that the corpus uses often."""
    size = len(candidate)
    flat = np.frombuffer(candidate.encode(), np.uint8)
    kinds = np.where(
        (flat >= 97) & (flat <= 122), 0, np.where((flat >= 65) & (flat <= 90), 1, np.where((flat >= 48) & (flat <= 57), 2, 3))
    )
    shares = np.bincount(kinds, minlength=4) / size
    changes = kinds[1:] != kinds[:-1]
    to_digit = changes & ((kinds[1:] == 2) | (kinds[:-1] == 2))
    frequency = np.bincount(flat)
    frequency = frequency[frequency > 0] / size
    known = common[_pieces(flat)]
    previous, following = _NEAR_BEFORE.search(before), _NEAR_AFTER.match(after)
    row = [
        size,
        *shares,
        changes.mean(),
        to_digit.mean(),
        float(-(frequency * np.log2(frequency)).sum()),
        known.mean(),
        float(np.isin(flat, np.frombuffer(b"0123456789abcdefABCDEF", np.uint8)).mean()),
        float(before.rstrip(" \"'").endswith(("=", ":"))),
        float(before.endswith(('"', "'"))),
        float(after[:1] in "\"'" and after != ""),
        float(before == "" or before[-1] == "\n"),
    ]
    for word, buckets in (
        (previous and previous[1], _WORD_BUCKETS),
        (following and following[1], _WORD_BUCKETS),
        (path, _PATH_BUCKETS),
    ):
        hashed = [0.0] * buckets
        if word:
            hashed[_bucket(word, buckets)] = 1.0
        row.extend(hashed)
    return row


def signature_label(candidate: str, before: str) -> float:
    return float(any(form.fullmatch(candidate) and lead.search(before) for form, lead in SIGNATURES))


def candidates(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Every candidate of (doc_id, text, path): doc_id, at (in characters), secret, label, x."""
    marks = np.packbits(common).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.unpackbits(np.frombuffer(marks, np.uint8), count=_LETTERS**3).astype(bool)
        for batch in blocks(batches):
            rows = []
            ids, paths = batch.column("doc_id").to_pylist(), batch.column("path").to_pylist()
            for doc, text, path in zip(ids, texts_of(batch), paths, strict=True):
                for found in CANDIDATE.finditer(text):
                    start, end = found.span()
                    before, after = text[max(0, start - _BEFORE) : start], text[end : end + _BEFORE]
                    secret = found[0]
                    rows.append(
                        (doc, start, secret, signature_label(secret, before), features(secret, before, after, path or "", used))
                    )
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.float64()),
                    pa.array(columns[4], pa.list_(pa.float64())),
                ],
                ["doc_id", "at", "secret", "label", "x"],
            )

    return docs.mapInArrow(run, "doc_id long, at long, secret string, label double, x array<double>")


def common_pieces(counts: np.ndarray) -> np.ndarray:
    """Pieces of three letters that make up at least one in 100,000 of all."""
    return counts * 100_000 >= max(1, counts.sum())


def scan(docs: DataFrame, path: str | None = None, findings: DataFrame | None = None) -> DataFrame:
    """Secrets found in the documents: doc_id, at, n_chars, secret_sha256, score.

    `path` names the column with a document's path; `findings` are labelled rows (label, x) with the features
    of this module.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.col(path) if path else F.lit(None)).cast("string").alias("path"),
    )
    found = checkpointed(candidates(slim, common_pieces(fragment_counts(docs))))
    findings = _sample(found) if findings is None else findings.withColumn("weight", F.lit(1.0))
    known = checkpointed(findings.select("label", "weight", array_to_vector("x").alias("features")))
    labels = {row["label"] for row in known.select("label").distinct().limit(3).collect()}
    if len(labels) < 2:
        return _report(found.withColumn("score", F.lit(max(labels, default=0.0)).cast("double")))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=11, subsamplingRate=0.8, weightCol="weight"
    ).fit(known)
    scored = forest.transform(found.withColumn("features", array_to_vector("x")))
    return _report(scored.withColumn("score", F.element_at(vector_to_array("probability"), 2)))


def _sample(found: DataFrame) -> DataFrame:
    """label, x, weight of up to SAMPLE different candidates of each label, those with the lowest hashes."""
    drawn = found.withColumn("draw", F.xxhash64(F.lit("findings"), "secret", "x"))
    keys = drawn.select("label", "draw").distinct()
    taken = {}
    for label in (0.0, 1.0):
        lowest = keys.where(F.col("label") == label).orderBy("draw").limit(SAMPLE)
        row = lowest.agg(F.max("draw").alias("last"), F.count("*").alias("n")).first()
        if row["n"]:
            taken[label] = row
    total = sum(row["n"] for row in taken.values())
    within, weight = F.lit(False), F.lit(1.0)
    for label, row in taken.items():
        own = F.col("label") == label
        within = within | (own & (F.col("draw") <= row["last"]))
        weight = F.when(own, F.lit(total / (len(taken) * row["n"]))).otherwise(weight)
    return drawn.where(within).dropDuplicates(["label", "draw"]).select("label", "x", weight.alias("weight"))


def _report(scored: DataFrame) -> DataFrame:
    return scored.where("score >= 0.5").select(
        "doc_id",
        "at",
        F.length("secret").cast("long").alias("n_chars"),
        F.sha2("secret", 256).alias("secret_sha256"),
        "score",
    )
