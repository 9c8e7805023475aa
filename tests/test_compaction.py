from __future__ import annotations

import pytest
from fixtures import catalog, event, wire

from tidemart.operators.events import enrich, parse_events
from tidemart.schemas import USER_EVENTS
from tidemart.sinks import compaction
from tidemart.sources.streams import file_stream
from tidemart.sources.tables import NO_DAY, partition_scan, read_days, read_table
from tidemart.streaming import runs

DAY = "2024-03-01"


def ingest(spark, root, batches, start=0):
    """Each batch of records becomes one micro-batch."""
    for number, records in enumerate(batches, start):
        wire(spark, records).coalesce(1).write.parquet(f"{root}/wire/{number:04d}")
    stream = file_stream(spark, f"{root}/wire/*", "parquet", max_files_per_trigger=1)
    return runs.finish(runs.start_event_ingest(stream, catalog(spark), f"{root}/events", f"{root}/checkpoint"))


def batches(count):
    return [
        [event(10 * i + j, ts=f"2024-03-0{1 + j % 3}T{(i + j) % 3:02d}:00:00Z") for j in range(5)] + ["broken", event(9, ts="?")]
        for i in range(count)
    ]


@pytest.fixture
def root(spark, tmp_path):
    assert ingest(spark, str(tmp_path), batches(12)) == 72
    return str(tmp_path)


def whole(spark, root):
    return sorted(map(tuple, read_table(spark, f"{root}/events", USER_EVENTS).collect()), key=repr)


def expected(spark, root):
    rows = enrich(parse_events(spark.read.parquet(f"{root}/wire/*")), catalog(spark)).select(*USER_EVENTS.fieldNames())
    return sorted(map(tuple, rows.collect()), key=repr)


def test_one_day_is_read_without_listing_the_others(spark, root):
    location = f"{root}/events"
    day = read_days(spark, location, USER_EVENTS, [DAY])
    same = partition_scan(read_table(spark, location, USER_EVENTS), DAY)
    assert sorted(map(tuple, day.collect()), key=repr) == sorted(map(tuple, same.collect()), key=repr)
    listed = day.inputFiles()
    assert 0 < len(listed) < len(same.inputFiles()) and all(f"dt={DAY}" in file for file in listed)
    assert {row["dt"] for row in read_days(spark, location, USER_EVENTS, [DAY, "2024-03-03", "1999-01-01"]).collect()} == {DAY, "2024-03-03"}
    assert read_days(spark, location, USER_EVENTS, ["1999-01-01"]).count() == 0
    assert {row["dt"] for row in read_days(spark, location, USER_EVENTS, [NO_DAY]).collect()} == {None}


def test_compaction_changes_no_row_and_leaves_few_files(spark, root):
    before, location = whole(spark, root), f"{root}/events"
    assert before == expected(spark, root)
    others = read_days(spark, location, USER_EVENTS, ["2024-03-02", "2024-03-03"]).inputFiles()
    many = len(read_days(spark, location, USER_EVENTS, [DAY]).inputFiles())
    assert compaction.compact_day(spark, location, DAY, USER_EVENTS)
    assert whole(spark, root) == before
    assert len(read_days(spark, location, USER_EVENTS, [DAY]).inputFiles()) <= 3 < many
    assert sorted(read_days(spark, location, USER_EVENTS, ["2024-03-02", "2024-03-03"]).inputFiles()) == sorted(others)
    # Nothing is left to do, for this day and for one that is not there.
    assert not compaction.compact_day(spark, location, DAY, USER_EVENTS)
    assert not compaction.compact_day(spark, location, "1999-01-01", USER_EVENTS)
    # New rows of the day are added, and put together with the others by the next call.
    assert ingest(spark, root, batches(14)[12:], start=12) == 12
    assert whole(spark, root) == expected(spark, root)
    assert compaction.compact_day(spark, location, DAY, USER_EVENTS)
    assert whole(spark, root) == expected(spark, root)


def test_a_micro_batch_repeated_after_compaction_adds_nothing_twice(spark, root, tmp_path):
    assert compaction.compact_day(spark, f"{root}/events", DAY, USER_EVENTS)
    # As if the job had died after writing the last micro-batch and before taking note of it.
    for name in ("11", ".11.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    ingest(spark, root, [])
    assert whole(spark, root) == expected(spark, root)


@pytest.mark.parametrize("dies_in", ["_note", "_publish"])
def test_a_compaction_that_died_is_finished_by_the_next(spark, root, monkeypatch, dies_in):
    before, location = whole(spark, root), f"{root}/events"

    class Died(Exception):
        pass

    def die(*_):
        raise Died

    with monkeypatch.context() as patch, pytest.raises(Died):
        patch.setattr(compaction, dies_in, die)
        compaction.compact_day(spark, location, DAY, USER_EVENTS)
    assert whole(spark, root) == before
    assert compaction.compact_day(spark, location, DAY, USER_EVENTS)
    assert whole(spark, root) == before
    assert len(read_days(spark, location, USER_EVENTS, [DAY]).inputFiles()) <= 3
    assert not compaction.compact_day(spark, location, DAY, USER_EVENTS)


def test_a_publication_cut_short_is_repeated_from_what_was_written_aside(spark, root, tmp_path):
    import shutil

    before, location = whole(spark, root), f"{root}/events"
    assert compaction.compact_day(spark, location, DAY, USER_EVENTS)
    # The day is half there, and nothing says that it was published.
    notes = spark.read.parquet(f"{location}/_merged/notes").where("state = 'ready'").collect()
    schema = spark.read.parquet(f"{location}/_merged/notes").schema
    spark.createDataFrame(notes, schema).write.mode("overwrite").parquet(f"{location}/_merged/notes")
    shutil.rmtree(tmp_path / "events" / f"dt={DAY}" / "hr=00")
    assert compaction.compact_day(spark, location, DAY, USER_EVENTS)
    assert whole(spark, root) == before


def test_touched_days(spark, root):
    assert runs.touched_days(spark, f"{root}/checkpoint", -1, 11) == ["2024-03-01", "2024-03-02", "2024-03-03", NO_DAY]
    assert runs.touched_days(spark, f"{root}/checkpoint", 11, 11) == []
    ingest(spark, root, [[event(1, ts="2024-02-09T00:00:00Z")], [event(1, ts="2024-02-10T00:00:00Z")]], start=12)
    assert runs.touched_days(spark, f"{root}/checkpoint", 11, 13) == ["2024-02-09", "2024-02-10"]
    assert runs.touched_days(spark, f"{root}/checkpoint", 12, 13) == ["2024-02-10"]
    for number in (999, 1000, 2500):
        runs.note_days(spark, f"{root}/far", number, [f"day-{number}"])
    assert runs.touched_days(spark, f"{root}/far", 998, 2500) == ["day-1000", "day-2500", "day-999"]
    assert runs.touched_days(spark, f"{root}/far", 999, 2499) == ["day-1000"]
