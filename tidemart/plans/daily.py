"""The daily run: wait for data, ingest it, check it, build the marts."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions import money
from tidemart.operators import marts, quality
from tidemart.operators.lookup import BROADCAST_BYTES
from tidemart.plans.layout import (
    DAILY_REVENUE,
    EVENT_MEASURES,
    EVENTS,
    HOURLY,
    QUALITY_LOG,
    QUALITY_STATES,
    RAW_EVENTS,
    REVENUE,
    TOP_PRODUCTS,
    CatalogLayout,
    FolderLayout,
    Table,
)
from tidemart.schemas import EVENT_TYPES
from tidemart.sinks.jdbc import append_jdbc
from tidemart.sources.tables import NO_DAY, partition_scan
from tidemart.streaming.runs import Report, finish, start_event_ingest, start_raw_ingest, touched_days

log = logging.getLogger(__name__)


Layout = FolderLayout | CatalogLayout

# What a run over the touched days is noted as.
TOUCHED = "touched"


@dataclass
class DailyOutcome:
    """`ready` is false for a run that was skipped because there was nothing to do."""

    ready: bool
    ingested: int = 0
    checks: list = field(default_factory=list)
    # The days built, where only touched ones were.
    days: list = field(default_factory=list)


def utc_today() -> date:
    return datetime.now(timezone.utc).date()


def utc_yesterday() -> date:
    return utc_today() - timedelta(days=1)


def source_ready(records: DataFrame, ts: str | None = None, since=None) -> bool:
    """Whether there is a record, or one newer than `since` if that is given.

    Reads a few files first and more only while none of them has such a record. A source
    that cannot be read is not ready.
    """
    try:
        wanted = records if since is None else records.filter(F.col(ts) > F.lit(since))
        return bool(wanted.select(F.lit(1)).take(1))
    except (PySparkException, Py4JJavaError) as error:
        log.warning("source not ready: %s", str(error).splitlines()[0])
        return False


def ingest_events(
    wire: DataFrame,
    products: DataFrame,
    layout: Layout,
    every: str | None = None,
    report: Report | None = None,
    keep_measures: bool = False,
) -> StreamingQuery:
    return start_event_ingest(
        wire, products, layout.place(EVENTS), layout.checkpoint(EVENTS), every,
        layout.table_format, layout.as_table, report=report,
        measures=layout.place(EVENT_MEASURES) if keep_measures else None,
    )


def ingest_raw_events(
    wire: DataFrame, layout: Layout, every: str | None = None, report: Report | None = None
) -> StreamingQuery:
    return start_raw_ingest(
        wire, layout.place(RAW_EVENTS), layout.checkpoint(RAW_EVENTS), every,
        layout.table_format, layout.as_table, report=report,
    )


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the newest micro-batch that a stream has finished, -1 before the first."""
    try:
        files = spark.read.format("binaryFile").load(f"{checkpoint}/commits")
    except PySparkException:
        return -1
    number = F.regexp_extract("path", r"/commits/(\d+)$", 1)
    numbers = files.select(number.alias("n")).where("n <> ''")
    found = numbers.agg(F.max(F.col("n").cast("int")).alias("n")).first()["n"]
    return -1 if found is None else found


def _finished_runs(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.read.schema("day string, batch int").json(f"{layout.checkpoint(EVENTS)}-daily-runs")


def already_built(spark: SparkSession, layout: Layout, day: str | None, batch: int) -> bool:
    """Whether a run for this day has ended well on the events up to this micro-batch."""
    try:
        runs = _finished_runs(spark, layout)
        return not runs.where((F.col("day") == (day or "all")) & (F.col("batch") == batch)).isEmpty()
    except PySparkException:
        return False


def note_built(spark: SparkSession, layout: Layout, day: str | None, batch: int) -> None:
    row = spark.createDataFrame([(day or "all", batch)], "day string, batch int")
    row.coalesce(1).write.mode("append").json(f"{layout.checkpoint(EVENTS)}-daily-runs")


def touched_since_built(spark: SparkSession, layout: Layout, last: int) -> list[str]:
    """Days with rows from micro-batches that no run over all or all touched days has seen yet, up to `last`."""
    if layout.as_table:
        raise ValueError("only streams into folders take down which days they touch")
    try:
        runs = _finished_runs(spark, layout).where(F.col("day").isin("all", TOUCHED))
        built = runs.agg(F.max("batch").alias("batch")).first()["batch"]
    except PySparkException:
        built = None
    return touched_days(spark, layout.checkpoint(EVENTS), -1 if built is None else built, last)


def refresh_states(
    spark: SparkSession, layout: Layout, days: Sequence[str], valid_types: Sequence[str] = EVENT_TYPES
) -> None:
    """Count what the checks need anew for some days and keep it; only these days are read.

    A day that has no events any more loses its counts. All days have to be counted with the same valid types.
    """
    if not days:
        return
    counted = quality.daily_profile(layout.read_days(spark, EVENTS, days), valid_types).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        layout.replace_partitions(counted, QUALITY_STATES)
        present = {row["dt"] or NO_DAY for row in counted.select("dt").collect()}
        for day in set(days) - present:
            layout.replace_day(counted, QUALITY_STATES, day)
    finally:
        counted.unpersist()


def report_from_states(spark: SparkSession, layout: Layout) -> DataFrame:
    """The checks of the whole table from the counts that are kept of its days."""
    return quality.report_of(quality.summed_profile(layout.read(spark, QUALITY_STATES)))


def check_quality(
    events: DataFrame,
    layout: Layout,
    run_date: str,
    valid_types: Sequence[str] = EVENT_TYPES,
    show: Callable[[str], None] = log.info,
    metrics_jdbc: dict | None = None,
    enforced: bool = True,
) -> list:
    """Check, log, show the report, and raise if a check failed, unless checks are not `enforced`.

    The events are scanned once. `metrics_jdbc` are the settings of `append_jdbc` where the log is kept
    in a database as well.
    """
    return conclude(quality.report(events, valid_types), layout, run_date, show, metrics_jdbc, enforced)


def conclude(
    checks: DataFrame,
    layout: Layout,
    run_date: str,
    show: Callable[[str], None] = log.info,
    metrics_jdbc: dict | None = None,
    enforced: bool = True,
) -> list:
    """Log and show a report, and raise if a check failed, unless checks are not `enforced`."""
    checks = checks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = quality.metrics_log(checks, run_date).coalesce(1)
        layout.append(rows, QUALITY_LOG)
        if metrics_jdbc:
            append_jdbc(rows, **metrics_jdbc)
        show(quality.describe(checks))
        if enforced:
            quality.enforce(checks)
        return checks.collect()
    finally:
        checks.unpersist()


def build_marts(
    events: DataFrame,
    products: DataFrame,
    layout: Layout,
    day: str | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
) -> None:
    """Replace the marts of one day, or of all days in the events.

    Amounts and products are scanned once, for the cube that three of the marts are added up
    from; the catalog is read once. Events without a readable time belong to no day. A given day
    that has no events any more is emptied in every mart.
    """
    dated = events.filter(F.col("dt").isNotNull()) if day is None else partition_scan(events, day)
    _write_marts(marts.daily_cube(dated), marts.with_measures(dated), products, layout, day, broadcast_limit)


def build_marts_from_measures(
    measures: DataFrame, products: DataFrame, layout: Layout, broadcast_limit: int = BROADCAST_BYTES
) -> None:
    """Replace the marts of all days in the measures that are kept of micro-batches; no event is read."""
    dated = measures.filter(F.col("dt").isNotNull())
    _write_marts(marts.summed_cube(dated), dated, products, layout, None, broadcast_limit)


def uncovered_days(spark: SparkSession, layout: FolderLayout, days: Sequence[str]) -> list[str]:
    """Days whose measures do not stand for as many events as their counts for the checks say there are.

    Their events came before measures were kept, or were replaced by hand.
    """
    day = F.coalesce("dt", F.lit(NO_DAY)).alias("day")
    kept = layout.read_days(spark, EVENT_MEASURES, days).groupBy(day).agg(F.sum(money.EVENT_COUNT).alias("kept"))
    there = layout.read_days(spark, QUALITY_STATES, days).groupBy(day).agg(F.sum("total").alias("there"))
    both = there.join(kept, "day", "full").where(~F.col("kept").eqNullSafe(F.col("there")))
    return sorted(row["day"] for row in both.select("day").collect())


def build_touched(spark: SparkSession, layout: FolderLayout, products: DataFrame, days: Sequence[str]) -> None:
    """Build the marts of some days from measures, and from the events where the measures do not cover them."""
    scanned = uncovered_days(spark, layout, days)
    covered = [day for day in days if day not in scanned]
    if covered:
        build_marts_from_measures(layout.read_days(spark, EVENT_MEASURES, covered), products, layout)
    if scanned:
        log.info("days built from their events: %s", ", ".join(scanned))
        build_marts(layout.read_days(spark, EVENTS, scanned), products, layout)


def _write_marts(
    cube: DataFrame, hourly: DataFrame, products: DataFrame, layout: Layout, day: str | None, broadcast_limit: int
) -> None:
    cube = cube.persist(StorageLevel.MEMORY_AND_DISK)
    listings = marts.catalog_listings(products).persist(StorageLevel.MEMORY_AND_DISK)

    def replace(rows: DataFrame, table: Table) -> None:
        if day is None:
            layout.replace_partitions(rows, table)
        else:
            layout.replace_day(rows, table, day)

    try:
        revenue = marts.revenue_by_category(cube, products, broadcast_limit, listings)
        revenue = revenue.persist(StorageLevel.MEMORY_AND_DISK)
        replace(revenue, REVENUE)
        replace(marts.daily_revenue(revenue), DAILY_REVENUE)
        revenue.unpersist()
        replace(marts.top_products(cube, products, broadcast_limit, listings), TOP_PRODUCTS)
        replace(marts.hourly_counts(hourly), HOURLY)
    finally:
        cube.unpersist()
        listings.unpersist()


def run_daily(
    spark: SparkSession,
    wire: DataFrame,
    products: DataFrame,
    layout: Layout,
    run_date: str,
    day: str | None = None,
    ready: bool = True,
    valid_types: Sequence[str] = EVENT_TYPES,
    checked_day: str | None = None,
    skip_built: bool = False,
    report: Report | None = None,
    metrics_jdbc: dict | None = None,
    touched: bool = False,
    keep_measures: bool = False,
    enforced: bool = True,
) -> DailyOutcome:
    """Ingest what the stream `wire` holds, check the fact table, build the marts.

    With `touched`, the marts of exactly those days are built that have rows from micro-batches since the last
    such run, so rows that come late reach the marts of their day. The checks are then made from counts
    kept by day, and other days are not read at all. With `keep_measures` as well, ingest keeps what each micro-batch
    adds to the marts, and the marts of a day are added up from that instead of its events.

    `checked_day` limits the checks to one day of a table too large to check whole. `ready`
    is the answer of `source_ready`; without data the run is skipped, not failed. With `skip_built`
    it is also skipped if there was nothing new to ingest since the last run for this day that ended well.
    A failed check raises after it has been logged, and leaves the marts as they were. With `enforced` off it is
    logged and shown as well, but the marts are built all the same.
    """
    if not ready:
        return DailyOutcome(ready=False)
    ingested = finish(ingest_events(wire, products, layout, report=report, keep_measures=keep_measures))
    batch = last_batch(spark, layout.checkpoint(EVENTS))
    if skip_built and already_built(spark, layout, TOUCHED if touched else day, batch):
        return DailyOutcome(ready=False)
    if touched:
        days = touched_since_built(spark, layout, batch)
        refresh_states(spark, layout, days, valid_types)
        found = report_from_states(spark, layout)
        checks = conclude(found, layout, run_date, metrics_jdbc=metrics_jdbc, enforced=enforced)
        if days and keep_measures:
            build_touched(spark, layout, products, days)
        elif days:
            build_marts(layout.read_days(spark, EVENTS, days), products, layout)
        note_built(spark, layout, TOUCHED, batch)
        return DailyOutcome(ready=True, ingested=ingested, checks=checks, days=days)
    events = layout.read(spark, EVENTS) if day is None else layout.read_days(spark, EVENTS, [day])
    checked = layout.read(spark, EVENTS) if checked_day is None else layout.read_days(spark, EVENTS, [checked_day])
    checks = check_quality(checked, layout, run_date, valid_types, metrics_jdbc=metrics_jdbc, enforced=enforced)
    build_marts(events, products, layout, day)
    note_built(spark, layout, day, batch)
    return DailyOutcome(ready=True, ingested=ingested, checks=checks)
