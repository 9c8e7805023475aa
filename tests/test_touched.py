from __future__ import annotations

import os
from datetime import datetime, timezone

import pytest
from fixtures import catalog, event, facts, wire
from pyspark.sql import functions as F

from tidemart.operators import quality
from tidemart.plans import daily, readiness
from tidemart.plans.layout import EVENTS, QUALITY_LOG, QUALITY_STATES, REVENUE, CatalogLayout, FolderLayout
from tidemart.sinks.tables import append
from tidemart.sources.streams import file_stream


def sale(user, day, amount=10.0):
    return event(user, "purchase", "mouse", amount, f"2024-03-{day:02d}T10:00:00Z")


def run(spark, root, records):
    wire(spark, records).coalesce(1).write.mode("append").parquet(f"{root}/wire")
    stream = file_stream(spark, f"{root}/wire", "parquet")
    return daily.run_daily(spark, stream, catalog(spark), FolderLayout(root), "2024-03-09", touched=True)


def revenue(spark, root):
    return {row["dt"]: row["total_revenue"] for row in FolderLayout(root).read(spark, REVENUE).collect()}


def test_late_rows_reach_the_marts_of_their_days_and_no_other_day_is_written(spark, tmp_path):
    root = str(tmp_path)
    first = run(spark, root, [sale(i, day) for day in range(1, 5) for i in range(3)] + [event(5, ts="?")])
    assert first.days == [*[f"2024-03-0{day}" for day in range(1, 5)], daily.NO_DAY] and first.checks[0]["value"] == 13.0
    mart = tmp_path / "analytics" / "daily_revenue_by_category"
    written = {file: file.stat().st_mtime_ns for file in mart.glob("dt=*/*.parquet")}
    second = run(spark, root, [sale(7, 2), sale(8, 4, 2.5), sale(9, 5)])
    assert second.days == ["2024-03-02", "2024-03-04", "2024-03-05"] and second.checks[0]["value"] == 16.0
    assert revenue(spark, root) == {
        "2024-03-01": 30.0, "2024-03-02": 40.0, "2024-03-03": 30.0, "2024-03-04": 32.5, "2024-03-05": 10.0
    }
    for file, time_written in written.items():
        kept = "dt=2024-03-01" in str(file) or "dt=2024-03-03" in str(file)
        assert (file.exists() and file.stat().st_mtime_ns == time_written) == kept
    assert run(spark, root, ["broken"]).days == []


def test_a_failed_gate_leaves_the_days_to_the_next_run(spark, tmp_path):
    root = str(tmp_path)
    run(spark, root, [sale(1, 1), sale(2, 2)])
    with pytest.raises(quality.QualityGateError):
        run(spark, root, [sale(3, 1, -1.0)])
    assert revenue(spark, root) == {"2024-03-01": 10.0, "2024-03-02": 10.0}
    with pytest.raises(quality.QualityGateError):
        run(spark, root, [sale(4, 2)])
    assert daily.touched_since_built(spark, FolderLayout(root), 2) == ["2024-03-01", "2024-03-02"]


def test_tables_of_a_catalog_do_not_tell_their_days(spark, tmp_path):
    with pytest.raises(ValueError, match="folders"):
        daily.touched_since_built(spark, CatalogLayout(str(tmp_path)), 3)


def test_counts_kept_by_day_equal_a_scan(spark, tmp_path):
    layout = FolderLayout(str(tmp_path))
    rows = [(i if i % 7 else None, ("purchase", "view", "odd", None)[i % 4], "p", float(i % 5), f"2024-03-0{1 + i % 3}", "01") for i in range(90)]
    rows += [(1, "purchase", "p", 1.0, None, None)]
    events = facts(spark, rows)
    append(events.withColumns({"category": F.lit("c"), "ts": F.lit(""), "event_time": F.lit(None).cast("timestamp")}), layout.place(EVENTS), ("dt", "hr"))
    days = ["2024-03-01", "2024-03-02", "2024-03-03", daily.NO_DAY]

    def same(frame):
        kept = daily.report_from_states(spark, layout).collect()
        return sorted(kept) == sorted(quality.report(frame).collect())

    daily.refresh_states(spark, layout, days)
    assert layout.read(spark, QUALITY_STATES).count() == 4 and same(events)
    # Only what is asked for is read again: a day that has gone keeps its counts until then.
    import shutil

    shutil.rmtree(f"{layout.place(EVENTS)}/dt=2024-03-02")
    daily.refresh_states(spark, layout, ["2024-03-01"])
    assert same(events)
    daily.refresh_states(spark, layout, ["2024-03-02"])
    assert same(events.where("dt IS NULL OR dt <> '2024-03-02'"))
    daily.refresh_states(spark, layout, [])
    empty = quality.report_of(quality.summed_profile(layout.read(spark, QUALITY_STATES).limit(0)))
    assert sorted(empty.collect()) == sorted(quality.report(events.limit(0)).collect())


def test_a_folder_is_ready_when_it_has_newer_files(spark, tmp_path):
    (tmp_path / "wire").mkdir()
    folder = str(tmp_path / "wire")

    def source():
        return readiness.HighWater(spark, str(tmp_path / "marks"), readiness.files_after(spark, folder))

    assert not source().probe() and source().mark() is None
    (tmp_path / "wire" / "a.txt").write_text("{}\n{}\n")
    os.utime(tmp_path / "wire" / "a.txt", (1_700_000_000, 1_700_000_000))
    first = source()
    assert first.probe() and source().probe()
    first.keep()
    kept = source().mark()
    assert abs(kept.timestamp() - (tmp_path / "wire" / "a.txt").stat().st_mtime) < 0.01
    again = source()
    assert not again.probe()
    again.keep()
    assert source().mark() == kept
    (tmp_path / "wire" / "b.txt").write_text("{}\n")
    os.utime(tmp_path / "wire" / "b.txt", (1_700_000_000.25, 1_700_000_000.25))
    later = source()
    assert later.probe()
    # Files that were there before are left out when the folder is listed.
    assert [file.rsplit("/", 1)[1] for file in readiness.files_after(spark, folder)(kept).inputFiles()] == ["b.txt"]


def test_a_source_that_cannot_be_read_is_not_ready(spark, tmp_path):
    source = readiness.HighWater(spark, str(tmp_path / "marks"), readiness.files_after(spark, str(tmp_path / "missing")))
    assert not source.probe()
    source.keep()
    assert source.mark() is None


def test_reading_of_a_topic_starts_at_the_mark():
    mark = datetime.fromtimestamp(1_700_000_000.5, timezone.utc).astimezone().replace(tzinfo=None)
    options = readiness.kafka_probe_options("host:1", "topic", mark)
    assert options["startingTimestamp"] == "1700000000500" and options["subscribe"] == "topic"
    assert "startingTimestamp" not in readiness.kafka_probe_options("host:1", "topic", None)


def test_checks_that_are_not_enforced_are_logged_and_do_not_stop_a_run(spark, tmp_path):
    root = str(tmp_path)
    for rows, touched in (([sale(1, 1), sale(2, 2, 0.0)], True), ([sale(3, 1)], False)):
        wire(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/wire")
        stream = file_stream(spark, f"{root}/wire", "parquet")
        outcome = daily.run_daily(
            spark, stream, catalog(spark), FolderLayout(root), "2024-03-09", touched=touched, enforced=False
        )
        assert [row["check_name"] for row in outcome.checks if row["status"] == quality.FAILURE] == ["purchase amount > 0"]
    assert revenue(spark, root) == {"2024-03-01": 20.0, "2024-03-02": 0.0}
    assert FolderLayout(root).read(spark, QUALITY_LOG).where("status = 'FAILURE'").count() == 2
