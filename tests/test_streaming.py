from __future__ import annotations

import pytest
from fixtures import catalog, event, wire
from pyspark.sql import functions as F

from tidemart.operators.events import enrich, parse_events, parse_raw_events
from tidemart.operators.metrics import throughput
from tidemart.schemas import RAW_EVENTS, USER_EVENTS
from tidemart.sources.streams import file_stream
from tidemart.sources.tables import read_table
from tidemart.streaming import runs


def records(first, count):
    good = [
        event(user_id=i, product=("mouse", "phone", "gone")[i % 3], amount=i / 4,
              ts=f"2024-03-{1 + i % 3:02d}T{i % 24:02d}:00:00Z")
        for i in range(first, first + count)
    ]
    return [*good, "broken", None, {"user_id": "text"}]


def arrive(spark, folder, batch):
    wire(spark, batch).repartition(3).write.mode("append").parquet(folder)


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_stream_equals_batch_and_a_restart_adds_only_new_records(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("wire", "events", "checkpoint"))
    arrive(spark, source, records(0, 40))

    def ingest():
        stream = file_stream(spark, source, "parquet", max_files_per_trigger=2)
        return runs.finish(runs.start_event_ingest(stream, catalog(spark), target, checkpoint))

    def stored():
        return read_table(spark, target, USER_EVENTS)

    def expected():
        return enrich(parse_events(spark.read.parquet(source)), catalog(spark))

    assert ingest() == 40
    assert stored().count() == 40 and same_rows(stored(), expected())
    assert ingest() == 0
    assert stored().count() == 40
    arrive(spark, source, records(100, 7))
    assert ingest() == 7
    assert stored().count() == 47 and same_rows(stored(), expected())


def test_large_catalog(spark, tmp_path):
    arrive(spark, str(tmp_path / "wire"), records(0, 30))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for salts in (None, 4):
            target = str(tmp_path / f"events-{salts}")
            stream = file_stream(spark, str(tmp_path / "wire"), "parquet")
            query = runs.start_event_ingest(
                stream, catalog(spark), target, f"{target}-checkpoint", broadcast_limit=0, salts=salts
            )
            assert runs.finish(query) == 30
            wanted = enrich(parse_events(spark.read.parquet(str(tmp_path / "wire"))), catalog(spark))
            assert same_rows(read_table(spark, target, USER_EVENTS), wanted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_writes_of_a_stream_get_few_files(spark, tmp_path):
    batch = [event(user_id=i) for i in range(200)]
    wire(spark, batch).repartition(12).write.parquet(str(tmp_path / "wire"))
    stream = file_stream(spark, str(tmp_path / "wire"), "parquet")
    assert runs.adapts(stream)
    target = tmp_path / "events"
    runs.finish(runs.start_event_ingest(stream, catalog(spark), str(target), str(tmp_path / "c")))
    assert len(list(target.glob("dt=2024-03-01/hr=10/batch=*/*.parquet"))) == 1


def test_raw_stream(spark, tmp_path):
    (tmp_path / "wire").mkdir()
    lines = ['{"user_id":"u","event":"e","amount":3,"ts":"t"}', "bad", '{"user_id":"v","amount":1.5}']
    (tmp_path / "wire" / "a.txt").write_text("\n".join(lines) + "\n")
    target = str(tmp_path / "raw")
    stream = file_stream(spark, str(tmp_path / "wire"))
    assert runs.finish(runs.start_raw_ingest(stream, target, str(tmp_path / "c"))) == 3
    batch = parse_raw_events(spark.read.text(str(tmp_path / "wire")))
    assert same_rows(read_table(spark, target, RAW_EVENTS), batch)


def test_stream_into_a_catalog_table(spark, tmp_path):
    arrive(spark, str(tmp_path / "wire"), ['{"user_id":"u"}', "bad"])
    stream = file_stream(spark, str(tmp_path / "wire"), "parquet")
    query = runs.start_raw_ingest(stream, "raw_events", str(tmp_path / "c"), as_table=True)
    assert runs.finish(query) == 2
    assert spark.read.table("raw_events").count() == 2


def test_standing_job(spark, tmp_path):
    arrive(spark, str(tmp_path / "wire"), records(0, 5))
    stream = file_stream(spark, str(tmp_path / "wire"), "parquet")
    query = runs.start_raw_ingest(stream, str(tmp_path / "t"), str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        arrive(spark, str(tmp_path / "wire"), ["late"])
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_table(spark, str(tmp_path / "t"), RAW_EVENTS).count() == 9
    assert runs.written_rows(query) == 9


@pytest.mark.parametrize("late_by, closed", [("1 minute", 3), ("3 minutes", 1)])
def test_throughput_stream_emits_closed_windows(spark, tmp_path, late_by, closed):
    seconds = [0, 10, 59, 60, 100, 130, 185, 245]
    frame = spark.createDataFrame([(s,) for s in seconds], "s int").select(
        F.timestamp_seconds(F.lit(1_700_000_040) + F.col("s")).alias("ts")
    )
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    target = str(tmp_path / "out")
    runs.start_throughput(stream, "ts", target, str(tmp_path / "c"), late_by).awaitTermination()
    batch = throughput(frame, "ts").orderBy("window_start").limit(closed)
    assert batch.count() == closed
    assert same_rows(read_table(spark, target), batch)


def test_a_stopped_run_is_continued_without_loss_or_copies(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("wire", "events", "checkpoint"))
    for start in range(0, 60, 10):
        arrive(spark, source, records(start, 10))
    stream = file_stream(spark, source, "parquet", max_files_per_trigger=1)
    query = runs.start_event_ingest(stream, catalog(spark), target, checkpoint, every="0 seconds")
    while not any(progress.numInputRows for progress in query.recentProgress):
        query.awaitTermination(1)
    query.stop()
    assert 0 < read_table(spark, target, USER_EVENTS).count()
    stream = file_stream(spark, source, "parquet")
    runs.finish(runs.start_event_ingest(stream, catalog(spark), target, checkpoint))
    wanted = enrich(parse_events(spark.read.parquet(source)), catalog(spark))
    assert same_rows(read_table(spark, target, USER_EVENTS), wanted) and wanted.count() == 60


def test_every_micro_batch_is_counted(spark, tmp_path):
    source = tmp_path / "wire"
    source.mkdir()
    for i in range(115):
        (source / f"{i:03d}.txt").write_text('{"user_id":"u"}\n')
    seen = []
    stream = file_stream(spark, str(source), max_files_per_trigger=1)
    query = runs.start_raw_ingest(
        stream, str(tmp_path / "t"), str(tmp_path / "c"), report=lambda batch, rows: seen.append((batch, rows))
    )
    assert runs.finish(query) == 115 and len(query.recentProgress) <= 100
    assert seen == [(i, 1) for i in range(115)]
    assert not (tmp_path / "t" / "_spark_metadata").exists()


def test_a_repeated_micro_batch_adds_nothing_twice(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("wire", "events", "checkpoint"))
    arrive(spark, source, records(0, 20))

    def ingest():
        stream = file_stream(spark, source, "parquet")
        return runs.finish(runs.start_event_ingest(stream, catalog(spark), target, checkpoint))

    assert ingest() == 20
    # As if the job had died after writing and before taking note of it.
    for name in ("0", ".0.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    assert ingest() == 20
    wanted = enrich(parse_events(spark.read.parquet(source)), catalog(spark))
    assert same_rows(read_table(spark, target, USER_EVENTS), wanted)
    # Another stream into the same folder replaces nothing.
    stream = file_stream(spark, source, "parquet")
    assert runs.finish(runs.start_event_ingest(stream, catalog(spark), target, str(tmp_path / "other"))) == 20
    assert read_table(spark, target, USER_EVENTS).count() == 40


def test_a_catalog_that_outgrows_the_limit_is_joined_otherwise(spark, tmp_path, monkeypatch):
    from tidemart.operators import lookup as lookups

    answers = []
    measured = lookups.fits_broadcast
    monkeypatch.setattr(lookups, "fits_broadcast", lambda *a: answers.append(measured(*a)) or answers[-1])
    source, listed = str(tmp_path / "wire"), str(tmp_path / "products")
    catalog(spark).limit(1).write.parquet(listed)
    products = spark.read.schema("name string, category string").parquet(listed)
    arrive(spark, source, records(0, 5))
    stream = file_stream(spark, source, "parquet")
    query = runs.start_event_ingest(
        stream, products, str(tmp_path / "t"), str(tmp_path / "c"), every="1 second", broadcast_limit=200
    )
    try:
        query.processAllAvailable()
        catalog(spark).write.mode("append").parquet(listed)
        spark.catalog.refreshByPath(listed)
        arrive(spark, source, records(50, 5))
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_table(spark, str(tmp_path / "t"), USER_EVENTS).count() == 10
    assert answers[0] and len(answers) >= 2


def test_lateness_has_to_be_given(spark, tmp_path):
    with pytest.raises(TypeError):
        runs.start_throughput(spark.readStream.format("rate").load(), "timestamp", str(tmp_path / "t"), str(tmp_path / "c"))
