"""Registered queries on tables of few rows that the given ones have no example of."""

from __future__ import annotations

from datetime import datetime, timedelta

import duckdb
import pytest

import __spark_entry__ as registered
from tidemart.plans import reports

SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "part": "p_partkey long, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey long, c_name string",
    "documents": "doc_id long, text string",
}


def tables(spark, folder, events):
    """The tables that events are made from; an event is (ts, type, value)."""
    rows = {
        "events": [(i, ts, i % 7, kind, value, f'{{"k": {i % 3}}}') for i, (ts, kind, value) in enumerate(events)],
        "part": [(0, "TIN", 10, 5.0), (1, "BRASS", 10, 6.0)],
        "customer": [(1, "Customer#1")],
        "documents": [(1, "no event")],
    }
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def as_sql(name, folder):
    duck = duckdb.connect()
    for table in SCHEMAS:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    answer = duck.execute(registered.oracle_sql()[name])
    return sorted(map(repr, answer.fetchall())), [column[0] for column in answer.description]


@pytest.mark.parametrize("name", ["late_days_rebuilt", "marts_from_measures"])
def test_marts_of_late_days_where_a_purchase_has_no_amount(spark, tmp_path, name):
    start = datetime(2024, 1, 10)
    kinds = ("purchase", "view", "error")
    events = [(start + timedelta(hours=5 * i), kinds[i % 3], float(i % 4)) for i in range(60)]
    assert any(kind == "purchase" and value == 0 for _, kind, value in events)
    folder = tables(spark, tmp_path, events)
    wanted, columns = as_sql(name, folder)
    found = registered.queries()[name](spark, folder).select(*columns).collect()
    assert sorted(repr(tuple(row)) for row in found) == wanted and wanted


def test_files_of_a_stream_grow_in_number_with_its_records_and_make_up_four_micro_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "_FILE_RECORDS", 10)
    events = [(datetime(2024, 1, 15, i % 2), "view", float(i)) for i in range(200)]
    folder = tables(spark, tmp_path / "given", events)
    wanted, columns = as_sql("compacted_events", folder)
    places, sizes = [], []
    make, ingest = reports.scratch_dir, reports.runs.start_event_ingest
    monkeypatch.setattr(reports, "scratch_dir", lambda *args: places.append(make(*args)) or places[-1])
    monkeypatch.setattr(
        reports.runs, "start_event_ingest", lambda *args: ingest(*args, report=lambda _, rows: sizes.append(rows))
    )
    found = reports.compacted_events(spark, folder).select(*columns).collect()
    assert sorted(repr(tuple(row)) for row in found) == wanted
    files = spark.read.parquet(f"{places[0]}/wire").groupBy("_metadata.file_path").count().collect()
    assert len(files) >= 20 and max(row["count"] for row in files) <= 12
    assert len(sizes) == 4 and min(sizes) > 40
