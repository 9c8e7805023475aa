"""Removal of repeated runs of lines, by windows of three consecutive lines.

Every three consecutive lines of a document are one window. A window that also stands earlier (in a
document with a smaller id, or further up in the same one) is a later occurrence, and all lines
that it covers go; overlapping windows merge into longer runs. Windows are judged on the input.

Each window is identified by 128 bits of hashes. Windows are first added up inside each task to
their first place and a count, so a window that a third of all documents share is one row per task
there; only the repeated ones are joined back, by a sort-merge join whose hot keys adaptive
execution splits.

Defined results: a null text has no lines and stays null; an empty text is one empty line; texts of fewer
than three lines have no window and stay as they are; windows of three blank lines (white space
only) do not count; rows that share an id are told apart by a check value of their texts and come in
its order, equal ones are one occurrence; rows without an id are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.columns import let, named

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, check, at (first line, from 0) and the two halves of the key of every window."""

    def keys(lines: Column) -> Column:
        def key(at: Column) -> Column:
            window = F.slice(lines, at + 1, WINDOW)
            return F.when(
                F.exists(window, lambda line: line.rlike(r"\S")),
                F.struct(
                    at.cast("int").alias("at"),
                    F.xxhash64(window).alias("k1"),
                    F.xxhash64(F.lit("second"), window).alias("k2"),
                ),
            )

        count = F.size(lines)
        return F.when(
            count >= WINDOW, F.transform(F.sequence(F.lit(0), count - WINDOW), key)
        )

    found = docs.select(
        "doc_id", _check(F.col("text")).alias("check"), F.explode(let(_lines(F.col("text")), keys)).alias("w")
    )
    return found.where("w IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "check", "w.at", "w.k1", "w.k2")


def _check(text: Column) -> Column:
    """Tells texts under one id apart."""
    return F.crc32(text.cast("binary"))


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, check and the starts of those windows of a document that also stand earlier."""
    every = windows(docs)
    place = F.struct("doc_id", "check", "at")
    first = (
        every.groupBy("k1", "k2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first < last")
    )
    return (
        every.join(first.select("k1", "k2", "first").hint("merge"), ["k1", "k2"])
        .where(place > F.col("first"))
        .groupBy("doc_id", "check")
        .agg(F.collect_set("at").alias("starts"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of docs, with text cleaned, and n_lines, n_removed in place of columns of these names."""
    docs = docs.drop("n_lines", "n_removed")
    starts = repeated(named(docs, "doc_id", "text")).select(
        F.col("doc_id").alias("_in"), F.col("check").alias("_check"), F.col("starts").alias("_starts")
    )

    def cleaned(lines: Column) -> Column:
        covered = F.array_distinct(
            F.flatten(F.transform("_starts", lambda at: F.sequence(at, at + (WINDOW - 1))))
        )
        return let(
            covered,
            lambda gone: F.struct(
                F.size(gone).cast("long").alias("n_removed"),
                F.array_join(
                    F.transform(
                        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone),
                        lambda at: F.element_at(lines, at + 1),
                    ),
                    "\n",
                ).alias("text"),
            ),
        )

    lines = _lines(F.col("text").cast("string"))
    own = (F.col("doc_id").cast("long") == F.col("_in")) & (_check(F.col("text").cast("string")) == F.col("_check"))
    done = docs.join(starts.hint("merge"), own, "left").withColumn(
        "_cleaned", F.when(F.col("_starts").isNotNull(), let(lines, cleaned))
    )
    kept = F.when(F.col("_cleaned").isNotNull(), F.col("_cleaned.text")).otherwise(F.col("text"))
    return done.select(
        *[kept.alias("text") if name == "text" else F.col(name) for name in docs.columns],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce("_cleaned.n_removed", F.lit(0)).cast("long").alias("n_removed"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of what is left (null for a null text)."""
    return dedup_lines(named(docs, "doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


# The same in DuckDB, on the lines themselves instead of hashes of them.
LINE_SQL = r"""
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
placed AS (
    SELECT doc_id, unnest(range(1, len(lines) - 1)) AS pos, lines FROM cut WHERE len(lines) >= 3
),
windows AS (
    SELECT doc_id, pos, lines[pos:pos + 2] AS w FROM placed
    WHERE regexp_matches(array_to_string(lines[pos:pos + 2], ''), '[^ \t\n\f\r\x0b]')
),
numbered AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS place FROM windows
),
gone AS (
    SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS line FROM numbered WHERE place > 1
),
each AS (
    SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line, unnest(lines) AS content FROM cut
),
kept AS (
    SELECT e.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
           coalesce(string_agg(content, chr(10) ORDER BY e.line) FILTER (g.line IS NULL), '') AS left_over
    FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.line = g.line
    GROUP BY e.doc_id
)
SELECT doc_id, n_lines, n_removed, sha256(left_over) AS kept_sha256 FROM kept
UNION ALL
SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
