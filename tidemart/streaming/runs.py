"""Streaming ingest and streaming throughput.

A checkpoint belongs to one query and one target. Restarting a run on its checkpoint continues
where it stopped and adds nothing twice. Into folders each micro-batch is written by itself, as an
ordinary batch: to folders named by the id of the query and the number of the micro-batch, below the
partitions of the table, which a repeated micro-batch replaces. No log of files is kept, joins and writes of
a micro-batch are planned by its own size, and reading a day lists that day only. The days a micro-batch has
rows of are noted beside the checkpoint, so that their marts can be built again; folders of finished
micro-batches can be put together (see `sinks.compaction`). Into catalog tables with their own metadata
Spark's native sink writes.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemart.operators.events import enrich, parse_events, parse_raw_events
from tidemart.operators.lookup import BROADCAST_BYTES
from tidemart.operators.marts import hourly_measures
from tidemart.operators.metrics import throughput
from tidemart.schemas import RAW_EVENTS, USER_EVENTS, USER_EVENTS_PARTITIONS
from tidemart.session import ADAPTIVE_STREAMS
from tidemart.sinks.compaction import merged_days
from tidemart.sinks.tables import balanced, ensure_folder, overwrite_batch
from tidemart.sources.tables import NO_DAY

log = logging.getLogger(__name__)

# How often a standing job starts a micro-batch.
STANDING_INTERVAL = "60 seconds"

# Tasks that hot products are shared among where the catalog is too large to broadcast and the engine
# has no adaptive execution.
STREAM_SALTS = 16

# Micro-batches whose notes about days share a folder.
NOTED_TOGETHER = 1000

DAY = "dt"

_OBSERVED = "written"

Report = Callable[[int, int], None]


def adapts(wire: DataFrame) -> bool:
    """Whether this engine knows adaptive execution of streams; it then uses it (see `session`)."""
    return wire.sparkSession.conf.isModifiable(ADAPTIVE_STREAMS)


class _Count(StreamingQueryListener):
    """Rows written by one run, added up from every micro-batch, however many there are."""

    def __init__(self, name: str, report: Report | None) -> None:
        self.name, self.report = name, report
        self.rows, self.run = 0, None
        self.ended = threading.Event()

    def add(self, batch: int, rows: int) -> None:
        self.rows += rows
        log.info("%s: micro-batch %d wrote %d rows", self.name, batch, rows)
        if self.report is not None:
            self.report(batch, rows)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        observed = event.progress.observedMetrics.get(_OBSERVED)
        if observed is not None and event.progress.name == self.name:
            self.add(event.progress.batchId, observed["rows"])

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self.run is None or str(event.runId) == self.run:
            self.ended.set()


# By the id of the run; one entry for each run of this process.
_COUNTS: dict[str, _Count] = {}


def _observed(observation: Observation) -> dict:
    """What has been observed of rows that are written.

    Where Spark finds out on the way that there are no rows, it leaves out what observes them, and the
    observation has no value that could be read.
    """
    try:
        return observation.get
    except Py4JJavaError:
        return {"rows": 0}


def _writer(rows: DataFrame, checkpoint: str, name: str, every: str | None) -> DataStreamWriter:
    writer = rows.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def _start_native(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    name: str,
    every: str | None,
    table_format: str,
    partition_by: Sequence[str] = (),
    as_table: bool = False,
    report: Report | None = None,
) -> StreamingQuery:
    observed = rows.observe(_OBSERVED, F.count(F.lit(1)).alias("rows"))
    writer = _writer(observed, checkpoint, name, every).format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    count = _Count(name, report)
    rows.sparkSession.streams.addListener(count)
    query = writer.toTable(target) if as_table else writer.start(target)
    count.run = str(query.runId)
    _COUNTS[count.run] = count
    return query


def _start_batches(
    wire: DataFrame,
    rows_of: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    name: str,
    every: str | None,
    table_format: str,
    partition_by: Sequence[str] = (),
    report: Report | None = None,
    beside: Callable[[DataFrame, str], None] | None = None,
) -> StreamingQuery:
    count = _Count(name, report)
    started = threading.Event()
    writes_as: list[str] = []
    seen: set[int] = set()

    def write(batch: DataFrame, number: int) -> None:
        started.wait()
        spark, written_as = batch.sparkSession, f"{writes_as[0]}-{number}"
        rows = rows_of(batch)
        if beside is not None:
            # Before the rows themselves: where they are found, what is kept beside them is there as well.
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            beside(rows, written_as)
        held = rows
        if DAY in partition_by and not seen:
            # Only the first micro-batch of a run can be a repeated one. It leaves alone the days in which its
            # rows have been put together with others.
            merged = merged_days(spark, target, written_as)
            rows = rows.where(F.col(DAY).isNull() | ~F.col(DAY).isin(*merged)) if merged else rows
        seen.add(number)
        counted = [F.count(F.lit(1)).alias("rows")]
        if DAY in partition_by:
            # At most as many as there are days in one micro-batch.
            counted.append(F.collect_set(F.coalesce(DAY, F.lit(NO_DAY))).alias("days"))
        observation = Observation(f"{_OBSERVED}-{number}")
        overwrite_batch(rows.observe(observation, *counted), target, written_as, partition_by, table_format)
        seen_rows = _observed(observation)
        note_days(spark, checkpoint, number, seen_rows.get("days", []))
        count.add(number, seen_rows["rows"])
        if beside is not None:
            held.unpersist()

    query = _writer(wire, checkpoint, name, every).foreachBatch(write).start()
    # The id stays that of the checkpoint when a run is started again.
    writes_as.append(str(query.id))
    _COUNTS[str(query.runId)] = count
    count.ended.set()
    started.set()
    return query


def _notes(checkpoint: str, number: int) -> str:
    return f"{checkpoint}-days/from={number // NOTED_TOGETHER * NOTED_TOGETHER}"


def note_days(spark: SparkSession, checkpoint: str, number: int, days: Sequence[str]) -> None:
    """Take down which days a micro-batch has rows of."""
    if days:
        rows = spark.createDataFrame([(number, day) for day in days], "number long, day string")
        rows.coalesce(1).write.mode("append").json(_notes(checkpoint, number))


def touched_days(spark: SparkSession, checkpoint: str, after: int, last: int) -> list[str]:
    """Days that micro-batches after `after`, up to `last`, have rows of; only their notes are read."""
    days: set[str] = set()
    for start in range((after + 1) // NOTED_TOGETHER * NOTED_TOGETHER, last + 1, NOTED_TOGETHER):
        try:
            notes = spark.read.schema("number long, day string").json(_notes(checkpoint, start))
            rows = notes.where((F.col("number") > after) & (F.col("number") <= last)).select("day").distinct().collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        days.update(row["day"] for row in rows)
    return sorted(days)


def start_event_ingest(
    wire: DataFrame,
    products: DataFrame,
    target: str,
    checkpoint: str,
    every: str | None = None,
    table_format: str = "parquet",
    as_table: bool = False,
    broadcast_limit: int = BROADCAST_BYTES,
    salts: int = 1,
    report: Report | None = None,
    measures: str | None = None,
) -> StreamingQuery:
    """Parse, enrich and append events to the fact table partitioned by day and hour.

    Without `every` the run takes what is there and ends; with it, it is a standing job.
    `target` is a folder, or the name of a catalog table with `as_table`. The catalog is read and
    measured anew for each micro-batch; into a catalog table, Spark decides by its own
    statistics. `report` gets the number and the row count of every micro-batch. `measures` is a folder that
    gets what each micro-batch adds to the marts; a repeated micro-batch replaces its own there as well.
    """
    if as_table:
        if measures is not None:
            raise ValueError("measures are kept by streams into folders only")
        facts = enrich(parse_events(wire), products, broadcast_limit=None)
        if adapts(wire):
            facts = balanced(facts, USER_EVENTS_PARTITIONS)
        return _start_native(
            facts, target, checkpoint, "event_ingest", every, table_format,
            USER_EVENTS_PARTITIONS, as_table, report,
        )
    ensure_folder(wire.sparkSession, target, USER_EVENTS, table_format)
    return _start_batches(
        wire,
        lambda batch: enrich(parse_events(batch), products, broadcast_limit, salts or 1),
        target, checkpoint, "event_ingest", every, table_format, USER_EVENTS_PARTITIONS, report,
        None if measures is None else _measures_into(measures, table_format),
    )


def _measures_into(folder: str, table_format: str) -> Callable[[DataFrame, str], None]:
    def keep(rows: DataFrame, written_as: str) -> None:
        overwrite_batch(hourly_measures(rows), folder, written_as, USER_EVENTS_PARTITIONS, table_format)

    return keep


def start_raw_ingest(
    wire: DataFrame,
    target: str,
    checkpoint: str,
    every: str | None = None,
    table_format: str = "parquet",
    as_table: bool = False,
    report: Report | None = None,
) -> StreamingQuery:
    """Parse and append raw events; nothing is filtered or enriched."""
    if as_table:
        rows = parse_raw_events(wire)
        return _start_native(rows, target, checkpoint, "raw_ingest", every, table_format, (), as_table, report)
    ensure_folder(wire.sparkSession, target, RAW_EVENTS, table_format)
    return _start_batches(
        wire, parse_raw_events, target, checkpoint, "raw_ingest", every, table_format, (), report
    )


def start_throughput(
    events: DataFrame,
    ts: str,
    target: str,
    checkpoint: str,
    late_by: str,
    minutes: int = 1,
    every: str | None = None,
) -> StreamingQuery:
    """Append the throughput of each window once no event of it can come any more.

    An event more than `late_by` behind the newest of an earlier micro-batch is not counted,
    so files that are read in several micro-batches have to come in the order of time.
    The native sink writes the few rows of this stream.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late_by)
    return _start_native(throughput(timed, ts, minutes), target, checkpoint, "throughput", every, "parquet")


def finish(query: StreamingQuery) -> int:
    """Wait for a run that takes what is there, and count the rows it wrote."""
    query.awaitTermination()
    return written_rows(query)


def written_rows(query: StreamingQuery) -> int:
    """Rows written by this run so far; complete once it has ended or was told to process all."""
    count = _COUNTS[str(query.runId)]
    if not query.isActive:
        # The reports of a native sink arrive a moment later.
        count.ended.wait(60)
    return count.rows
