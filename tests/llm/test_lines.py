from __future__ import annotations

import random

import duckdb

from tests.llm.awkward import COLUMNS, awkward
from tidemart.llm.lines import LINE_SQL, dedup_lines, line_report


def _agrees(frame, arrow) -> None:
    connection = duckdb.connect()
    connection.register("documents", arrow)
    want = sorted(connection.sql(LINE_SQL).fetchall(), key=str)
    found = frame.select("doc_id", "n_lines", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=str) == want


def test_agrees_with_sql(spark):
    draw = random.Random(1)
    base = [f"line {i}" for i in range(12)] + ["", " "]
    rows = [(i, "\n".join(draw.choices(base, k=draw.randint(1, 12))) if i % 9 else None) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _agrees(line_report(docs), docs.toArrow())


def test_overlapping_windows_merge_and_first_places_stay(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "q\nq\nq\nq")], "doc_id long, text string")
    kept = {row.doc_id: row.text for row in dedup_lines(docs).collect()}
    assert kept == {1: "a\nb\nc\nd", 2: "x\ny", 3: "a\nb", 4: "q"}


def test_rows_that_share_an_id(spark):
    rows = [(1, "a\nb\nc"), (1, "x\ny\nz\nu\nv"), (1, "x\ny\nz\nu\nv"), (2, "q\nx\ny\nz"), (2, "a\nb\nc\nd")]
    found = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((row.doc_id, row.text) for row in found) == [
        (1, "a\nb\nc"), (1, "x\ny\nz\nu\nv"), (1, "x\ny\nz\nu\nv"), (2, "d"), (2, "q")
    ]


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), COLUMNS)
    found = dedup_lines(docs)
    assert [name for name in docs.columns if name != "n_lines"] == [n for n in found.columns if n not in ("n_lines", "n_removed")]
    rows = found.select("doc_id", "text", "n_lines", "n_removed").collect()
    assert len(rows) == len(awkward())
    by_id = {row.doc_id: row for row in rows}
    assert by_id[3].text is None and by_id[3].n_lines == 0
    assert by_id[4].text == "" and by_id[4].n_lines == 1
    assert by_id[7].n_removed < 10 and by_id[8].n_removed == 3000
    assert by_id[1].n_removed == 0 and by_id[2].text == ""
    assert dedup_lines(spark.createDataFrame([], COLUMNS)).count() == 0
