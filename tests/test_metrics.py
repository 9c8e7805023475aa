from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from fixtures import plan
from pyspark.sql import functions as F

from tidemart.functions import bands
from tidemart.operators import metrics
from tidemart.schemas import METRIC_SAMPLES

EPOCH = datetime(2024, 3, 1, tzinfo=timezone.utc)


def samples(spark, rows, metric="m"):
    """Samples from (series, milliseconds after the start, value)."""
    return spark.createDataFrame(
        [
            (metric, {"topic": name, "job": "broker"}, EPOCH + timedelta(milliseconds=ms), value)
            for name, ms, value in rows
        ],
        METRIC_SAMPLES,
    )


def brute_force(rows, width, step):
    """(series, window start in seconds) -> (samples, increase), by definition."""
    base = int(EPOCH.timestamp())
    highest = {}
    for name, ms, value in rows:
        if value is not None:
            highest[name, ms] = max(value, highest.get((name, ms), value))
    found = {}
    for name in {key[0] for key in highest}:
        points = sorted((ms, value) for (series, ms), value in highest.items() if series == name)
        first = (base + points[0][0] // 1000 - width) // step * step
        for start in range(first, base + points[-1][0] // 1000 + 1, step):
            low, high = (start - base) * 1000, (start - base + width) * 1000
            inside = [value for ms, value in points if low <= ms < high]
            if len(inside) < 2:
                continue
            grown = sum(b - a if b >= a else b for a, b in zip(inside, inside[1:]))
            found[name, start] = (len(inside), grown)
    return found


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("width, step", [(60, 60), (60, 15), (60, 45), (30, 60), (7, 7), (600, 60)])
def test_increase_equals_its_definition(spark, width, step, unique):
    rng = random.Random(width * 1000 + step)
    rows = []
    for name in ("a", "b", "c"):
        value, ms = 0.0, rng.randrange(5000)
        for _ in range(250):
            ms += rng.choice([1 if unique else 0, 1, 250, 1000, 3000, 15000, 70000])
            value = 0.0 if rng.random() < 0.1 else value + rng.randrange(5)
            rows.append((name, ms, None if rng.random() < 0.05 else value))
    frame = metrics.with_labels(samples(spark, rows), "topic")
    got = metrics.counter_increase(frame, ["topic"], width, step, unique)
    found = {
        (row["topic"], row["start"]): (row["samples"], row["increase"])
        for row in got.withColumn("start", F.unix_seconds("window_start")).collect()
    }
    assert found == brute_force(rows, width, step)


def test_rates(spark):
    rows = [("a", 0, 10.0), ("a", 30_000, 70.0), ("b", 0, 5.0), ("b", 59_000, 3.0), ("c", 0, 1.0)]
    frame = metrics.with_labels(samples(spark, rows), "topic")
    by_series = {r["topic"]: r["rate"] for r in metrics.counter_rate(frame, ["topic"], 60, 60).collect()}
    assert by_series == {"a": 1.0, "b": 0.05}
    row, = metrics.total_rate(frame, ["topic"], 60, 60).collect()
    assert row["rate"] == 63 / 60


def test_no_window_is_one_tasks_whole_series(spark):
    frame = metrics.with_labels(samples(spark, [("a", 0, 1.0)]), "topic")
    text = plan(metrics.counter_increase(frame, ["topic"], 60, 60, unique=True))
    assert text.count("Exchange hashpartitioning") == 2
    text = plan(metrics.counter_increase(frame, ["topic"], 60, 60))
    assert "SortAggregate" not in text
    assert "SinglePartition" not in text and "hashpartitioning(topic#" in text
    assert all("," in part.split(")")[0].rsplit(",", 1)[0] for part in text.split("hashpartitioning(")[1:])


def test_selector(spark):
    frame = samples(spark, [("a", 0, 1.0), ("b", 0, 2.0)]).unionByName(samples(spark, [("a", 0, 3.0)], "other"))
    chosen = metrics.select_series(frame, "m", topic="a", job="broker")
    assert [row["value"] for row in chosen.collect()] == [1.0]
    assert metrics.select_series(frame, "m", missing="x").count() == 0
    assert metrics.select_series(frame, "m").count() == 2


def test_latest_is_the_last_value_that_is_there(spark):
    rows = [("a", 0, 1.0), ("a", 1000, 2.0), ("a", 2000, None), ("b", 0, None), ("c", 5, 600.0)]
    frame = metrics.with_labels(samples(spark, rows), "topic")
    newest = metrics.latest(frame, ["topic"], metrics.sample_order(F.col("ts")))
    assert {row["topic"]: row["value"] for row in newest.collect()} == {"a": 2.0, "c": 600.0}


def test_latest_breaks_ties_and_needs_no_sort(spark):
    frame = spark.createDataFrame(
        [("a", 7, 1.0), ("a", 9, 2.0), ("a", 8, 3.0)], "topic string, seq long, value double"
    ).withColumn("ts", F.lit(EPOCH))
    newest = metrics.latest(frame, ["topic"], metrics.sample_order(F.col("ts"), F.col("seq")))
    assert newest.first()["value"] == 2.0
    assert "SortAggregate" not in plan(newest)
    early = frame.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("seq")))
    row = metrics.latest(early, ["topic"], metrics.sample_order(F.col("ts"), F.col("seq"))).first()
    assert row["value"] == 1.0


def test_lag_adds_up_the_latest_of_each_series(spark):
    rows = spark.createDataFrame(
        [("t1", "c1", 0, 10.0), ("t1", "c1", 1, 4.0), ("t1", "c2", 0, 0.3), ("t2", "c1", 0, 1.0)],
        "topic string, client string, s int, value double",
    ).withColumn("ts", F.timestamp_seconds("s"))
    lags = metrics.lag_by(rows, ["topic", "client"], "topic", metrics.sample_order(F.col("ts")))
    assert {row["topic"]: (row["series"], row["lag"]) for row in lags.collect()} == {
        "t1": (2, 4.3), "t2": (1, 1.0)
    }


@pytest.mark.parametrize(
    "value, band, jobs",
    [(None, None, None), (0.0, "green", "red"), (99.9, "green", "green"), (100.0, "yellow", "green"),
     (499.9, "yellow", "green"), (500.0, "red", "green"), (1.0, "green", "green"), (0.9, "green", "red")],
)
def test_threshold_bands(spark, value, band, jobs):
    frame = spark.createDataFrame([(value,)], "value double")
    row = metrics.latest_panel(frame).first()
    assert row["band"] == band
    assert metrics.latest_panel(frame, bands.RUNNING_JOBS_BANDS).first()["band"] == jobs


def test_gibibytes(spark):
    frame = spark.createDataFrame([(3.0 * 2**30,)], "value double")
    assert metrics.latest_panel(frame).first()["gib"] == 3.0


def test_throughput(spark):
    frame = spark.createDataFrame([(s,) for s in (0, 59, 60, 185)], "s int").select(
        F.timestamp_seconds(F.lit(1_700_000_040) + F.col("s")).alias("ts")
    )
    rows = metrics.throughput(frame, "ts").orderBy("window_start").collect()
    assert [(row["events"], row["per_second"]) for row in rows] == [(2, 2 / 60), (1, 1 / 60), (1, 1 / 60)]
    five = metrics.throughput(frame, "ts", 5).collect()
    assert sum(row["events"] for row in five) == 4
    assert all(row["per_second"] == row["events"] / 300 for row in five)
