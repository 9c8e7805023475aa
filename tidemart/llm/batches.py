"""Helpers shared by the operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Text bytes that one step of a vectorised operator works on at once.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that none holds much more than `limit` bytes of `column` (one row may)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [value or "" for value in batch.column(column).to_pylist()]


def flat_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and the n + 1 offsets of the texts in it."""
    values = pc.fill_null(batch.column(column).cast(pa.binary()), b"")
    offsets = np.frombuffer(values.buffers()[1], np.int32)[
        values.offset : values.offset + len(values) + 1
    ].astype(np.int64)
    data = values.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]
