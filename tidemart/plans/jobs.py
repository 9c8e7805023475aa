"""Command line of the jobs, for spark-submit (see `job.py`)."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators import quality
from tidemart.operators.marts import event_type_summary, top_sales, with_measures
from tidemart.plans import daily
from tidemart.plans.layout import EVENTS, CatalogLayout, FolderLayout
from tidemart.plans.readiness import HighWater, files_after, kafka_after
from tidemart.schemas import EVENT_TYPES
from tidemart.session import build_session, prepare
from tidemart.sinks.compaction import compact_day
from tidemart.sources.jdbc import JdbcSplit, read_jdbc
from tidemart.sources.streams import file_stream, kafka_stream
from tidemart.sources.tables import partition_scan, read_table
from tidemart.streaming import runs


class _Given(argparse.Action):
    """Remember that an argument was given, and is not its default."""

    def __call__(self, parser, namespace, value, option_string=None) -> None:
        setattr(namespace, self.dest, value)
        setattr(namespace, f"{self.dest}_given", True)


def _stream_arguments(parser: argparse.ArgumentParser, starting: str, tolerant: bool) -> None:
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="Kafka topic")
    parser.add_argument("--starting-offsets", default=starting, action=_Given)
    parser.set_defaults(starting_offsets_given=False)
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--wire-dir", help="folder of text files, instead of Kafka")
    parser.set_defaults(tolerant=tolerant)


def first_offsets(options: argparse.Namespace) -> str:
    """Where a new stream starts: a run that ends by itself would find nothing at `latest`."""
    standing = getattr(options, "every", None) is not None
    return options.starting_offsets if standing or options.starting_offsets_given else "earliest"


def _wire(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.wire_dir:
        return file_stream(spark, options.wire_dir)
    return kafka_stream(
        spark,
        options.servers,
        options.topic,
        starting_offsets=first_offsets(options),
        fail_on_data_loss=not options.tolerant,
        max_offsets_per_trigger=options.max_offsets_per_trigger,
        min_partitions=options.min_partitions,
    )


def _catalog_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--products", help="folder of the product table")
    parser.add_argument("--jdbc-url", help="database of the product table, instead of a folder")
    parser.add_argument("--jdbc-table", default="products")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-variable", help="environment variable with the password")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-split", help="numeric or date column to read ranges of in parallel")
    parser.add_argument("--jdbc-lower", help="start of the second range, about")
    parser.add_argument("--jdbc-upper", help="start of the last range, about")
    parser.add_argument("--jdbc-partitions", type=int, default=16)


def jdbc_split(options: argparse.Namespace) -> JdbcSplit | None:
    if options.jdbc_split is None:
        return None
    return JdbcSplit(options.jdbc_split, options.jdbc_lower, options.jdbc_upper, options.jdbc_partitions)


def _metrics_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--metrics-jdbc-url", help="database that keeps the quality log as well")
    parser.add_argument("--metrics-jdbc-table", default="data_quality_metrics")
    parser.add_argument("--metrics-jdbc-user")
    parser.add_argument("--metrics-jdbc-password-variable", help="environment variable with the password")
    parser.add_argument("--metrics-jdbc-driver")


def metrics_jdbc(options: argparse.Namespace) -> dict | None:
    """Settings of `append_jdbc` for the quality log."""
    if options.metrics_jdbc_url is None:
        return None
    secret = options.metrics_jdbc_password_variable
    properties = _present(
        user=options.metrics_jdbc_user,
        password=os.environ[secret] if secret else None,
        driver=options.metrics_jdbc_driver,
    )
    return {"url": options.metrics_jdbc_url, "table": options.metrics_jdbc_table, "properties": properties}


def _present(**properties: str | None) -> dict[str, str]:
    return {key: value for key, value in properties.items() if value is not None}


def _products(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.products:
        return read_table(spark, options.products)
    secret = options.jdbc_password_variable
    properties = _present(
        user=options.jdbc_user,
        password=os.environ[secret] if secret else None,
        driver=options.jdbc_driver,
    )
    return read_jdbc(
        spark, options.jdbc_url, options.jdbc_table, ["name", "category"], properties, jdbc_split(options)
    )


def _layout(options: argparse.Namespace) -> daily.Layout:
    if options.catalog_tables:
        return CatalogLayout(f"{options.root}/checkpoints", options.catalog, options.table_format)
    return FolderLayout(options.root, options.table_format, options.spread)


def _print_batch(number: int, rows: int) -> None:
    print(f"micro-batch {number}: {rows} rows", flush=True)


def _ingest(spark: SparkSession, options: argparse.Namespace) -> None:
    query = daily.ingest_events(
        _wire(spark, options), _products(spark, options), _layout(options), options.every, _print_batch,
        options.keep_measures,
    )
    print(f"wrote {runs.finish(query)} events")


def _raw_ingest(spark: SparkSession, options: argparse.Namespace) -> None:
    query = daily.ingest_raw_events(_wire(spark, options), _layout(options), options.every, _print_batch)
    print(f"wrote {runs.finish(query)} records")


def _events(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    return _layout(options).read(spark, EVENTS)


def _quality(spark: SparkSession, options: argparse.Namespace) -> None:
    events = _events(spark, options)
    scope = events if options.day is None else partition_scan(events, options.day)
    daily.check_quality(
        scope, _layout(options), options.run_date, options.valid_types, print, metrics_jdbc(options)
    )


def _marts(spark: SparkSession, options: argparse.Namespace) -> None:
    day = None if options.all_days else options.day
    daily.build_marts(_events(spark, options), _products(spark, options), _layout(options), day)
    print(f"built the marts of {day or 'all days'}")


def _daily(spark: SparkSession, options: argparse.Namespace) -> None:
    layout = _layout(options)
    if options.wire_dir:
        records_after = files_after(spark, options.wire_dir)
    else:
        records_after = kafka_after(spark, options.servers, options.topic)
    source = HighWater(spark, f"{layout.checkpoint(EVENTS)}-high-water", records_after)
    # Without anything new, a day can still be built that has not been.
    outcome = daily.run_daily(
        spark,
        _wire(spark, options),
        _products(spark, options),
        layout,
        options.run_date,
        options.day,
        source.probe() or source.mark() is not None,
        options.valid_types,
        None if options.check_all else options.checked_day or options.day,
        skip_built=True,
        report=_print_batch,
        metrics_jdbc=metrics_jdbc(options),
        touched=options.touched,
        keep_measures=options.keep_measures,
    )
    source.keep()
    print(f"ingested {outcome.ingested} events" if outcome.ready else "nothing to do")


def _summary(spark: SparkSession, options: argparse.Namespace) -> None:
    facts = with_measures(_events(spark, options))
    event_type_summary(facts).show(truncate=False)
    top_sales(spark, facts, _products(spark, options)).show(truncate=False)


def _compact(spark: SparkSession, options: argparse.Namespace) -> None:
    layout = _layout(options)
    if layout.as_table:
        raise ValueError("formats with their own metadata have compaction of their own")
    done = compact_day(spark, layout.place(EVENTS), options.day, EVENTS.schema, layout.table_format)
    print(f"put the files of {options.day} together" if done else "nothing to do")


def _setup(spark: SparkSession, options: argparse.Namespace) -> None:
    CatalogLayout(f"{options.root}/checkpoints", options.catalog, options.table_format).prepare(spark)


def _measure_argument(sub: argparse.ArgumentParser) -> None:
    text = "keep what each micro-batch adds to the marts, so that touched days need not be read again"
    sub.add_argument("--keep-measures", action="store_true", help=text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="job.py")
    commands = top.add_subparsers(required=True)

    def command(name, action, text):
        sub = commands.add_parser(name, help=text)
        sub.set_defaults(action=action)
        sub.add_argument("--root", required=True, help="folder of tables and checkpoints")
        sub.add_argument("--table-format", default="parquet")
        sub.add_argument("--catalog-tables", action="store_true", help="tables by name, not by folder")
        sub.add_argument("--catalog", help="name of the catalog, if it is not the default")
        sub.add_argument("--spread", type=int, help="shuffle partitions that writes to folders start from")
        return sub

    ingest = command("ingest", _ingest, "stream events into the fact table")
    _stream_arguments(ingest, starting="latest", tolerant=True)
    _catalog_arguments(ingest)
    _measure_argument(ingest)
    ingest.add_argument("--every", help="interval of a standing job, such as '60 seconds'")

    raw = command("raw-ingest", _raw_ingest, "stream raw events into their table")
    _stream_arguments(raw, starting="earliest", tolerant=False)
    raw.add_argument("--every")

    checks = command("quality", _quality, "check the fact table; fails if a check fails")
    _metrics_arguments(checks)
    checks.add_argument("--day", help="check this day only")
    checks.add_argument("--run-date", default=daily.utc_today().isoformat())
    checks.add_argument("--valid-types", nargs="+", default=EVENT_TYPES)

    marts = command("marts", _marts, "build the marts of a day, by default of yesterday")
    marts.add_argument("day", nargs="?", default=daily.utc_yesterday().isoformat())
    marts.add_argument("--all-days", action="store_true")
    _catalog_arguments(marts)

    whole = command("daily", _daily, "ingest, check and build the marts")
    whole.add_argument("day", nargs="?", help="day of the marts, by default all days")
    whole.add_argument("--touched", action="store_true", help="build exactly the days that have got new rows")
    _measure_argument(whole)
    _stream_arguments(whole, starting="earliest", tolerant=True)
    _catalog_arguments(whole)
    whole.add_argument("--run-date", default=daily.utc_today().isoformat())
    whole.add_argument("--checked-day", help="check this day, by default that of the marts")
    whole.add_argument("--check-all", action="store_true", help="check the whole table")
    _metrics_arguments(whole)
    whole.add_argument("--valid-types", nargs="+", default=EVENT_TYPES)

    summary = command("summary", _summary, "print totals by event type and the best-selling products")
    _catalog_arguments(summary)

    compact = command("compact", _compact, "put the files of a day together while no stream writes")
    compact.add_argument("day", nargs="?", default=daily.utc_yesterday().isoformat())

    command("setup", _setup, "create the catalog tables")
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    options = parser().parse_args(arguments)
    session = build_session("tidemart") if spark is None else prepare(spark)
    try:
        options.action(session, options)
    except quality.QualityGateError as error:
        print(error, file=sys.stderr)
        return 1
    finally:
        if spark is None:
            session.stop()
    return 0
