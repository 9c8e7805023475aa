from __future__ import annotations

import os

import pytest
from fixtures import catalog, event, wire
from pyspark.sql import functions as F

from tidemart.plans import daily
from tidemart.plans.layout import DAILY_REVENUE, EVENT_MEASURES, EVENTS, HOURLY, REVENUE, TOP_PRODUCTS, CatalogLayout, FolderLayout
from tidemart.schemas import USER_EVENTS
from tidemart.sinks.compaction import compact_day
from tidemart.sinks.tables import BATCH, overwrite_day
from tidemart.sources.streams import file_stream

MARTS = (REVENUE, DAILY_REVENUE, TOP_PRODUCTS, HOURLY)


def records(first, count):
    return [
        event(i, ("purchase", "view")[i % 2], ("mouse", "phone", "gone", None)[i % 4], i / 4 if i % 5 else None,
              f"2024-03-{1 + i % 3:02d}T{i % 24:02d}:00:00Z" if i % 11 else "?")
        for i in range(first, first + count)
    ]


def arrive(spark, root, rows):
    wire(spark, rows).repartition(2).write.mode("append").parquet(f"{root}/wire")


def run(spark, root, keep_measures=True):
    stream = file_stream(spark, f"{root}/wire", "parquet", max_files_per_trigger=1)
    layout = FolderLayout(root)
    return daily.run_daily(
        spark, stream, catalog(spark), layout, "2024-03-09", valid_types=("purchase", "view"), touched=True,
        keep_measures=keep_measures,
    )


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def same_as_a_full_build(spark, root):
    layout, whole = FolderLayout(root), FolderLayout(f"{root}/whole")
    daily.build_marts(layout.read(spark, EVENTS), catalog(spark), whole)
    return all(rows_of(layout.read(spark, mart)) == rows_of(whole.read(spark, mart)) for mart in MARTS)


@pytest.fixture(autouse=True)
def no_gate(monkeypatch):
    monkeypatch.setattr(daily.quality, "enforce", lambda checks: None)


def test_marts_of_many_micro_batches_equal_a_full_build(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(daily, "build_marts", None)
    for first in (0, 60, 90):
        arrive(spark, root, records(first, 50))
        run(spark, root)
    monkeypatch.undo()
    assert len({path.name for path in tmp_path.glob("analytics/event_measures/dt=*/hr=*/batch=*")}) == 6
    assert same_as_a_full_build(spark, root)


def test_a_repeated_micro_batch_counts_once(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, records(0, 60))
    run(spark, root)
    layout = FolderLayout(root)
    before = rows_of(layout.read(spark, EVENT_MEASURES))
    compact_day(spark, layout.place(EVENTS), "2024-03-02", USER_EVENTS)
    commits = tmp_path / "checkpoints" / "user_events" / "commits"
    for name in ("1", ".1.crc"):
        os.remove(commits / name)
    arrive(spark, root, records(60, 30))
    outcome = run(spark, root)
    assert outcome.days[:3] == ["2024-03-01", "2024-03-02", "2024-03-03"]
    assert len(rows_of(layout.read(spark, EVENT_MEASURES))) > len(before)
    assert daily.uncovered_days(spark, layout, outcome.days) == []
    assert same_as_a_full_build(spark, root)


def test_days_without_measures_are_built_from_their_events(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, records(0, 60))
    run(spark, root, keep_measures=False)
    arrive(spark, root, [row for row in records(60, 30) if "03-02" not in row["ts"]])
    days = run(spark, root).days
    layout = FolderLayout(root)
    assert daily.uncovered_days(spark, layout, days) == days and same_as_a_full_build(spark, root)


def test_a_day_replaced_by_hand_is_noticed(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, records(0, 60))
    run(spark, root)
    layout = FolderLayout(root)
    kept = layout.read(spark, EVENTS).where("dt = '2024-03-02' AND user_id < 30").withColumn(BATCH, F.lit("by hand"))
    kept.write.parquet(f"{root}/kept")
    kept = spark.read.parquet(f"{root}/kept")
    overwrite_day(kept, layout.place(EVENTS), "2024-03-02", partition_by=("hr", BATCH))
    arrive(spark, root, [event(1, "view", "mouse", 2.0, "2024-03-02T01:00:00Z")])
    with pytest.MonkeyPatch.context() as patch:
        scanned = []
        patch.setattr(daily, "build_marts", lambda events, *_: scanned.append(events))
        assert run(spark, root).days == ["2024-03-02"] and len(scanned) == 1


def test_measures_can_be_compacted(spark, tmp_path):
    root = str(tmp_path)
    arrive(spark, root, records(0, 60))
    run(spark, root)
    layout = FolderLayout(root)
    before = rows_of(layout.read(spark, EVENT_MEASURES))
    assert compact_day(spark, layout.place(EVENT_MEASURES), "2024-03-02", EVENT_MEASURES.schema)
    assert rows_of(layout.read(spark, EVENT_MEASURES)) == before


def test_streams_into_a_catalog_keep_no_measures(spark, tmp_path):
    stream = file_stream(spark, str(tmp_path), "parquet")
    with pytest.raises(ValueError, match="folders"):
        daily.ingest_events(stream, catalog(spark), CatalogLayout(str(tmp_path), table_format="parquet"), keep_measures=True)
