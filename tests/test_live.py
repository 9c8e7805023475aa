from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemart.operators import metrics
from tidemart.streaming import live

SCHEMA = "topic string, client string, ts timestamp, value double, sequence long"
SERIES = ["topic", "client"]


def samples(seed, count=300):
    draw = random.Random(seed)
    start = datetime(2024, 3, 1)
    return [
        (draw.choice(("a", "b", None)), draw.choice("xyz"),
         draw.choice((start + timedelta(seconds=draw.randint(0, 40)), None)) if draw.random() < 0.1
         else start + timedelta(seconds=draw.randint(0, 40)),
         draw.choice((1.0, 2.5, -1.0, None)), draw.choice((0, 1, 2, None)))
        for _ in range(count)
    ]


def by_force(rows):
    newest = {}
    for topic, client, ts, value, sequence in rows:
        if None not in (ts, value, sequence):
            newest[topic, client] = max(newest.get((topic, client), (datetime.min, 0, 0.0)), (ts, sequence, value))
    return sorted([(*key, ts, value, sequence) for key, (ts, sequence, value) in newest.items()], key=str)


def kept(spark, path):
    rows = spark.read.parquet(path).select("topic", "client", "ts", "value", "sequence").collect()
    return sorted(map(tuple, rows), key=str)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(folder)


def test_newest_samples_of_a_stream(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / name) for name in ("samples", "newest", "checkpoint"))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        live.start_newest(stream, path, checkpoint, SERIES, "sequence", buckets=3).awaitTermination()

    first, second = samples(1), samples(2, 40)
    arrive(spark, source, first)
    run()
    assert kept(spark, path) == by_force(first)
    # A restart goes on; what comes late, or a second time, changes nothing.
    late = [("a", "x", datetime(2024, 2, 1), 99.0, 9)]
    arrive(spark, source, second + first[:50] + late)
    run()
    assert kept(spark, path) == by_force(first + second)


def test_the_order_of_batches_does_not_matter(spark, tmp_path):
    rows = samples(3, 60)
    for name, parts in (("forth", (rows[:20], rows[20:], rows[:20])), ("back", (rows[20:], [], rows[:20]))):
        for part in parts:
            live.merge_newest(spark.createDataFrame(part, SCHEMA), str(tmp_path / name), SERIES, "sequence", 2)
        assert kept(spark, str(tmp_path / name)) == by_force(rows)


def test_only_buckets_with_new_samples_are_written(spark, tmp_path):
    path, many = str(tmp_path / "newest"), [(f"t{i}", "x", datetime(2024, 3, 1), 1.0, 0) for i in range(40)]
    live.merge_newest(spark.createDataFrame(many, SCHEMA), path, SERIES, "sequence", 16)
    written = {file: file.stat().st_mtime_ns for file in (tmp_path / "newest").glob("bucket=*/*.parquet")}
    live.merge_newest(spark.createDataFrame([("t7", "x", datetime(2024, 3, 2), 5.0, 0)], SCHEMA), path, SERIES, "sequence", 16)
    gone = {file.parent for file in written if not file.exists()}
    assert len(gone) == 1 and len({file.parent for file in written}) > 4
    assert spark.read.parquet(path).count() == 40


def test_nothing_yet(spark, tmp_path):
    path = str(tmp_path / "newest")
    live.merge_newest(spark.createDataFrame([], SCHEMA), path, SERIES, "sequence")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert live.read_newest(spark, path, schema).isEmpty()


def test_lag_of_a_kept_table_equals_that_of_all_samples(spark, tmp_path):
    rows = spark.createDataFrame(samples(5), SCHEMA).where("ts IS NOT NULL AND sequence IS NOT NULL AND value > 0")
    rows = rows.withColumn("sequence", F.monotonically_increasing_id())
    rows.write.parquet(str(tmp_path / "samples"))
    rows = spark.read.parquet(str(tmp_path / "samples"))
    live.merge_newest(rows, str(tmp_path / "newest"), SERIES, "sequence", 4)
    order = metrics.sample_order(F.col("ts"), F.col("sequence"))
    whole = metrics.lag_by(rows, SERIES, "topic", order)
    newest = metrics.lag_by(spark.read.parquet(str(tmp_path / "newest")), SERIES, "topic", order)
    assert sorted(map(str, whole.collect())) == sorted(map(str, newest.collect()))
