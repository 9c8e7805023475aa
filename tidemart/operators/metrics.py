"""Dashboard figures from metric samples `(metric, labels, ts, value)` and from events."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions import bands, money

_MICROS = 1_000_000
# Pieces a step of a rate is cut into, so that a busy step is not one task's work. It must
# divide the microseconds of a second, so that every piece lies inside one step.
_PIECES = 50


def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Samples of one metric whose labels have the given values."""
    wanted = F.col("metric") == metric
    for name, value in labels.items():
        wanted = wanted & (F.col("labels")[name] == value)
    return samples.filter(wanted)


def with_labels(samples: DataFrame, *names: str) -> DataFrame:
    """Labels as columns, which together identify a series."""
    return samples.select(*[F.col("labels")[name].alias(name) for name in names], "ts", "value")


def _growth(value: Column, before: Column) -> Column:
    """How far a counter moved on since the sample before; after a reset it restarts at 0."""
    return F.when(before.isNull(), 0.0).when(value >= before, value - before).otherwise(value)


def _floor_to(micros: Column, unit: int) -> Column:
    return micros - F.pmod(micros, F.lit(unit))


def _instants(samples: DataFrame, series: Sequence[str], unique: bool) -> DataFrame:
    """One value per series and instant, copies merged before they are shuffled."""
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    present = samples.filter(F.col("value").isNotNull())
    if unique:
        return present.select(*series, at, "value")
    return present.groupBy(*series, at).agg(F.max("value").alias("value"))


def counter_increase(
    samples: DataFrame,
    series: Sequence[str],
    width_seconds: int,
    step_seconds: int,
    unique: bool = False,
) -> DataFrame:
    """Increase of each counter in the windows `[start, start + width)`, one per step.

    Only pairs of samples inside a window count, and a window with a single sample of a
    series has no row for it. A series has one value per instant; of several, the highest
    is taken. `unique` promises that there are none, which saves a shuffle.

    Samples are compared inside short pieces of time first and the pieces are then joined up
    inside each window, so neither a long series nor a busy step is sorted by one task. With
    one value per instant a piece has at most one sample per microsecond.
    """
    pane = math.gcd(width_seconds, step_seconds) * _MICROS
    piece = pane // _PIECES
    instants = _instants(samples, series, unique).withColumn(
        "piece", _floor_to(F.col("at"), piece)
    )
    in_piece = W.partitionBy(*series, "piece").orderBy("at")
    pieces = (
        instants.withColumn("before", F.lag("value").over(in_piece))
        .withColumn("after", F.lead("value").over(in_piece))
        .groupBy(*series, "piece")
        .agg(
            F.count("*").alias("samples"),
            F.sum(_growth(F.col("value"), F.col("before"))).alias("increase"),
            F.max(F.when(F.col("before").isNull(), F.col("value"))).alias("first"),
            F.max(F.when(F.col("after").isNull(), F.col("value"))).alias("last"),
        )
    )
    step = step_seconds * _MICROS
    newest = _floor_to(F.col("piece"), step)
    starts = [newest - F.lit(back * step) for back in range(math.ceil(width_seconds / step_seconds))]
    in_window = W.partitionBy(*series, "start").orderBy("piece")
    return (
        pieces.withColumn("start", F.explode(F.array(*starts)))
        .filter(F.col("piece") < F.col("start") + F.lit(width_seconds * _MICROS))
        .withColumn("before", F.lag("last").over(in_window))
        .groupBy(*series, "start")
        .agg(
            F.sum("samples").alias("samples"),
            (F.sum("increase") + F.sum(_growth(F.col("first"), F.col("before")))).alias("increase"),
        )
        .filter(F.col("samples") >= 2)
        .select(
            *series,
            F.timestamp_micros("start").alias("window_start"),
            "samples",
            "increase",
        )
    )


def counter_rate(
    samples: DataFrame,
    series: Sequence[str],
    width_seconds: int,
    step_seconds: int,
    unique: bool = False,
) -> DataFrame:
    """Increase per second of each series."""
    increase = counter_increase(samples, series, width_seconds, step_seconds, unique)
    return increase.withColumn("rate", F.col("increase") / F.lit(float(width_seconds)))


def total_rate(
    samples: DataFrame,
    series: Sequence[str],
    width_seconds: int,
    step_seconds: int,
    unique: bool = False,
) -> DataFrame:
    """Increase per second of all series together."""
    increase = counter_increase(samples, series, width_seconds, step_seconds, unique)
    return increase.groupBy("window_start").agg(
        (F.sum("increase") / F.lit(float(width_seconds))).alias("rate")
    )


def sample_order(ts: Column, tie_break: Column | None = None) -> Column:
    """Orders samples by time, then by an integer tie-break that must not be negative.

    One number rather than a pair: aggregates over it need no sorting.
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    if tie_break is None:
        return micros
    return micros.cast("decimal(19,0)") * F.lit("10000000000000000000").cast(
        "decimal(20,0)"
    ) + tie_break.cast("decimal(19,0)")


def latest(samples: DataFrame, series: Sequence[str], order: Column) -> DataFrame:
    """The last value of each series that is not NULL, and its time."""
    return (
        samples.filter(F.col("value").isNotNull())
        .groupBy(*series)
        .agg(F.max("ts").alias("ts"), F.max_by("value", order).alias("value"))
    )


def latest_panel(values: DataFrame, thresholds=bands.MESSAGE_RATE_BANDS) -> DataFrame:
    """Latest values with their colour, and in GiB for panels that show bytes."""
    return values.withColumn("band", bands.threshold_band(F.col("value"), thresholds)).withColumn(
        "gib", bands.gibibytes(F.col("value"))
    )


def lag_by(samples: DataFrame, series: Sequence[str], label: str, order: Column) -> DataFrame:
    """Latest consumer lag of every series, added up by one of its labels."""
    newest = latest(samples, series, order)
    return (
        newest.select(label, *money.row_measures(F.col("value")))
        .groupBy(label)
        .agg(*money.summed_measures())
        .select(label, F.col(money.EVENT_COUNT).alias("series"), money.total().alias("lag"))
    )


def throughput(events: DataFrame, ts: str, minutes: int = 1) -> DataFrame:
    """Events per second in consecutive windows. On a stream `ts` needs a watermark."""
    return (
        events.groupBy(F.window(F.col(ts), f"{minutes} minutes").alias("span"))
        .agg(F.count("*").alias("events"))
        .select(
            F.col("span.start").alias("window_start"),
            "events",
            (F.col("events") / F.lit(60.0 * minutes)).alias("per_second"),
        )
    )
