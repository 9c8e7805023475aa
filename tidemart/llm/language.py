"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to three bytes. A byte costs -log2 of its
probability in the longest context that the tree knows; a byte that was not seen there pays the
escape probability of that context (method C: distinct successors over all successors plus distinct
ones) and is looked up in the next shorter context, without the bytes already excluded, down
to all byte values being equally likely. Statistics are frozen after training, so a context's code
lengths form one dense row, and a text costs one table look-up per byte and language. The
shortest total code wins; the score is its share among all languages.

Training reads a sample of labelled rows of bounded size: about `DOCS_PER_LANGUAGE` whole documents of
each language, drawn by a hash of the id, and keeps the `TREE_GRAMS` most frequent strings.
Prediction reads every whole text. Texts are lower-cased first.

Defined results: a text that is null, empty or without a letter gives `und` with score 0; without
training rows every text does; the first language by name wins a tie; repeated rows give repeated
results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.batches import blocks, texts_of
from tidemart.llm.columns import named, set_apart

ORDER = 3
DOCS_PER_LANGUAGE = 1500
# Strings of ORDER + 1 bytes kept over all languages.
TREE_GRAMS = 400_000
# Cells (contexts x byte classes x languages) of the table of code lengths.
TABLE_CELLS = 6_000_000
UNKNOWN = "und"
_STEP = 1 << 19


@dataclass
class LanguageModel:
    languages: list[str]
    byte_class: np.ndarray
    # Row of the longest known context, by the classes of the last ORDER bytes.
    slot: np.ndarray
    # Bits by row and byte class, one column per language.
    bits: np.ndarray
    classes: int


def is_held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with ORDER spaces before each text; start and length of each text."""
    data = [text.lower().encode("utf-8", "replace") for text in texts]
    lengths = np.array([len(value) for value in data], np.int64)
    gap = b" " * ORDER
    flat = np.frombuffer(gap + gap.join(data) + gap, np.uint8)
    starts = np.cumsum(lengths + ORDER) - lengths
    return flat, starts, lengths


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        flat, starts, lengths = _padded(texts_of(batch))
        codes = np.zeros(len(flat), np.int64)
        for back in range(ORDER + 1):
            codes[ORDER:] |= flat[ORDER - back : len(flat) - back].astype(np.int64) << (8 * back)
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        owner = np.full(len(flat), -1, np.int16)
        for lang, start, length in zip(langs, starts, lengths, strict=True):
            owner[start : start + length] = names.index(lang)
        for number, name in enumerate(names):
            grams, counts = np.unique(codes[owner == number], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(counts.astype(np.int64))],
                ["lang", "gram", "n"],
            )


def train(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Fit on rows of (doc_id, text, lang); null texts and languages are passed over."""
    rows = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").count().collect()
    if not sizes:
        return build({})
    scale = 1 << 30
    share = F.create_map(
        *[
            F.lit(value)
            for row in sizes
            for value in (row["lang"], int(scale * min(1.0, docs_per_language / row["count"])))
        ]
    )
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(scale))
    grams = (
        rows.where(draw < share[F.col("lang")])
        .select("lang", "text")
        .mapInArrow(_gram_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = grams.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= TREE_GRAMS // len(sizes)
    )
    counts: dict[str, list[tuple[int, int]]] = {row["lang"]: [] for row in sizes}
    for row in kept.select("lang", "gram", "n").collect():
        counts[row["lang"]].append((row["gram"], row["n"]))
    return build(counts)


def build(counts: dict[str, list[tuple[int, int]]]) -> LanguageModel:
    """Tables of code lengths from counts of strings of ORDER + 1 bytes per language."""
    languages = sorted(counts)
    tables = [np.array(sorted(counts[name]), np.int64).reshape(-1, 2) for name in languages]
    grams = [
        np.stack([(table[:, 0] >> (8 * back)) & 255 for back in range(ORDER, -1, -1)], axis=1)
        for table in tables
    ]
    seen = np.unique(np.concatenate([g.ravel() for g in grams] or [np.zeros(0, np.int64)]))
    classes = len(seen) + 1  # The last class stands for each byte that was never seen.
    byte_class = np.full(256, len(seen), np.int64)
    byte_class[seen.astype(np.int64)] = np.arange(len(seen))
    others = 256 - len(seen)
    width = np.ones(classes)
    width[-1] = max(others, 1)
    grams = [byte_class[g] for g in grams]

    # The most frequent contexts over all languages, shorter ones first.
    rows_left = max(1, TABLE_CELLS // (classes * max(1, len(languages)))) - 1
    contexts: list[np.ndarray] = [np.zeros(1, np.int64)]
    for order in range(1, ORDER + 1):
        keys = np.concatenate([_key(g[:, ORDER - order : ORDER], classes) for g in grams] or [np.zeros(0, np.int64)])
        weights = np.concatenate([t[:, 1] for t in tables] or [np.zeros(0, np.int64)])
        known, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights, len(known)) if len(known) else np.zeros(0)
        chosen = np.sort(known[np.argsort(-total, kind="stable")[:rows_left]])
        contexts.append(chosen)
        rows_left -= len(chosen)
    offsets = np.cumsum([0, *[len(c) for c in contexts]])

    bits = np.zeros((offsets[-1], classes, len(languages)), np.float32)
    for number, (gram, table) in enumerate(zip(grams, tables, strict=True)):
        below = np.full((1, classes), 1 / 256)
        parents = np.zeros(1, np.int64)
        for order in range(ORDER + 1):
            own = contexts[order]
            if order:
                # A context's parent lacks its first byte.
                shorter = own % classes ** (order - 1)
                found = np.searchsorted(contexts[order - 1], shorter)
                found = np.minimum(found, max(len(contexts[order - 1]) - 1, 0))
                parents = found
            prior = below[parents] if len(own) else np.zeros((0, classes))
            count = np.zeros((len(own), classes))
            if len(gram) and len(own):
                keys = _key(gram[:, ORDER - order : ORDER], classes)
                at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                known = own[at] == keys
                np.add.at(count, (at[known], gram[known, ORDER]), table[known, 1])
            distinct = (count > 0).sum(axis=1, keepdims=True)
            total = count.sum(axis=1, keepdims=True)
            left = (prior * width * (count == 0)).sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(left > 0, distinct / (total + distinct), 0)
                seen_here = count / np.where(left > 0, total + distinct, np.maximum(total, 1))
                inherited = escape * prior / np.where(left > 0, left, 1)
                mixed = np.where(count > 0, seen_here, inherited)
            below = np.where(total > 0, mixed, prior)
            bits[offsets[order] : offsets[order + 1], :, number] = -np.log2(np.maximum(below, 1e-12))

    slot = np.zeros((classes,) * ORDER, np.int32)
    for order in range(1, ORDER + 1):
        view = slot.reshape(-1, classes**order)
        view[:, contexts[order]] = offsets[order] + np.arange(len(contexts[order]), dtype=np.int32)
    return LanguageModel(
        languages, byte_class, slot.reshape(-1), bits.reshape(bits.shape[0] * bits.shape[1], bits.shape[2]), classes
    )


def _key(columns: np.ndarray, classes: int) -> np.ndarray:
    key = np.zeros(len(columns), np.int64)
    for column in columns.T:
        key = key * classes + column
    return key


def code_lengths(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Total bits of every text in every language."""
    flat, starts, lengths = _padded(texts)
    total = np.zeros((len(texts), len(model.languages)))
    classes = model.byte_class[flat]
    owner_end = starts + lengths
    for start in range(ORDER, len(flat), _STEP):
        stop = min(len(flat), start + _STEP)
        context = np.zeros(stop - start, np.int64)
        for back in range(ORDER, 0, -1):
            context = context * model.classes + classes[start - back : stop - back]
        rows = model.slot[context].astype(np.int64) * model.classes + classes[start:stop]
        cost = model.bits[rows]
        first, last = np.searchsorted(owner_end, start, side="right"), np.searchsorted(starts, stop)
        spans = np.empty(2 * (last - first), np.int64)
        spans[::2] = np.maximum(starts[first:last], start) - start
        spans[1::2] = np.minimum(owner_end[first:last], stop) - start
        if len(spans):
            # Sums between every two marks; those of gaps and of empty texts are not used.
            padded = np.vstack([cost, np.zeros((1, cost.shape[1]), cost.dtype)])
            sums = np.add.reduceat(padded, spans, axis=0, dtype=np.float64)[::2]
            total[first:last] += np.where((spans[1::2] > spans[::2])[:, None], sums, 0)
    return total


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of docs, and lang_pred, score and bits_per_byte in place of columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop("lang_pred", "score", "bits_per_byte")
    text = F.col("text").cast("string")
    rows = rows.withColumns(
        {"_text": text, "_lettered": F.coalesce(text.rlike(r"\p{L}"), F.lit(False))}
    )
    names = [name for name in rows.columns if name not in ("_text", "_lettered")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in blocks(batches, "_text"):
            texts = texts_of(batch, "_text")
            lettered = np.array(batch.column("_lettered").to_pylist(), bool)
            found = np.full(len(texts), UNKNOWN, object)
            score, density = np.zeros(len(texts)), np.zeros(len(texts))
            if own.languages:
                total = code_lengths(own, texts)
                best = total.argmin(axis=1)
                share = 1 / np.exp2(np.minimum(total.min(axis=1, keepdims=True) - total, 0)).sum(axis=1)
                sizes = np.array([max(1, len(text.encode("utf-8", "replace"))) for text in texts])
                found = np.where(lettered, np.array(own.languages, object)[best], UNKNOWN)
                score = np.where(lettered, share, 0.0)
                density = np.where(lettered, total.min(axis=1) / sizes, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(found, pa.string()), pa.array(score), pa.array(density)],
                [*names, "lang_pred", "score", "bits_per_byte"],
            )

    schema = T.StructType(
        [
            *rows.select(*names).schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("bits_per_byte", T.DoubleType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """Learn from the documents outside the fold, predict all: doc_id, held_out, lang_pred, score."""
    held_out = is_held_out(F.col("doc_id"), folds, fold)
    model = train(docs.where(~held_out))
    return predict(named(docs, "doc_id", "text"), model).select(
        "doc_id", is_held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents whose language can be told, learned from all that name theirs; columns as they were.

    Rejected are texts without a letter and those that no language explains better than the others together.
    """
    model = train(docs)

    def identified(rows: DataFrame) -> DataFrame:
        return predict(rows, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))

    return set_apart(docs, ("text",), identified)
