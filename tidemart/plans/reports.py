"""The registered queries: each takes a session and the folder of the given tables.

Queries about sinks and streams write to a new folder below the shared scratch folder and
return what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import bands
from tidemart.given import (
    HEALTHY_TYPES,
    consumer_lags,
    given,
    message_counters,
    products,
    user_events,
    wire_events,
    wire_raw_events,
)
from tidemart.operators import dimensions, events, marts, metrics, quality
from tidemart.plans import daily
from tidemart.plans.layout import DAILY_REVENUE, EVENTS, REVENUE, FolderLayout
from tidemart.plans.readiness import ARRIVED, HighWater
from tidemart.schemas import (
    CUSTOMERS,
    HOURLY_COUNTS,
    MART_PARTITIONS,
    QUALITY_METRICS,
    RAW_EVENTS,
    USER_EVENTS,
    USER_EVENTS_PARTITIONS,
)
from tidemart.session import prepare, scratch_dir
from tidemart.sinks.compaction import compact_day
from tidemart.sinks.tables import append, overwrite_day, overwrite_partitions
from tidemart.sources.streams import file_stream
from tidemart.sources.tables import read_days, read_table
from tidemart.streaming import live, runs


# Records in one file of a stream, at most about.
_FILE_RECORDS = 250_000


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.with_measures(user_events(spark, sf_dir))


# --- marts and ad-hoc queries ---------------------------------------------------------------


def daily_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return marts.revenue_by_category(_facts(spark, sf_dir), products(spark, sf_dir))


def daily_revenue_by_category_large_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a catalog that is too large to broadcast; the result is the same."""
    prepare(spark)
    return marts.revenue_by_category(_facts(spark, sf_dir), products(spark, sf_dir), broadcast_limit=0)


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as a run over all days leaves it behind."""
    prepare(spark)
    layout = FolderLayout(scratch_dir(spark, "daily-revenue"))
    daily.build_marts(user_events(spark, sf_dir), products(spark, sf_dir), layout)
    return layout.read(spark, DAILY_REVENUE)


def top_products_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart with the rank of every product in its day."""
    prepare(spark)
    return marts.with_rank(marts.top_products(_facts(spark, sf_dir), products(spark, sf_dir)))


def best_sellers_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return marts.best_sellers(marts.top_products(_facts(spark, sf_dir), products(spark, sf_dir)), 3)


def hourly_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return marts.hourly_counts(_facts(spark, sf_dir))


def event_type_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return marts.event_type_summary(_facts(spark, sf_dir))


def federated_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return marts.top_sales(spark, _facts(spark, sf_dir), products(spark, sf_dir))


def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    target = scratch_dir(spark, "partition-scan")
    facts = user_events(spark, sf_dir).drop("category")
    append(facts, target, USER_EVENTS_PARTITIONS)
    return read_days(spark, target, facts.schema, ["2024-01-15"])


# --- ingest ---------------------------------------------------------------------------------


def ingest_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return events.enrich(events.parse_events(wire_events(spark, sf_dir)), products(spark, sf_dir))


def ingest_enrich_large_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a catalog that is too large to broadcast; the result is the same."""
    prepare(spark)
    parsed = events.parse_events(wire_events(spark, sf_dir))
    return events.enrich(parsed, products(spark, sf_dir), broadcast_limit=0, salts=runs.STREAM_SALTS)


def _comparable(rows: DataFrame, name: str) -> DataFrame:
    """A column as DOUBLE, which clients show alike; integers with NULLs and decimals they do not."""
    return rows.withColumn(name, F.col(name).cast("double"))


def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _comparable(events.parse_raw_events(wire_raw_events(spark, sf_dir)), "amount")


def _wire_folder(spark: SparkSession, records: DataFrame, purpose: str) -> tuple[str, DataFrame]:
    """Records as files of a stream: the folder of the run, and the stream."""
    root = scratch_dir(spark, purpose)
    records.write.parquet(f"{root}/wire")
    return root, file_stream(spark, f"{root}/wire", "parquet")


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    root, wire = _wire_folder(spark, wire_events(spark, sf_dir), "ingest-stream")
    query = runs.start_event_ingest(
        wire, products(spark, sf_dir), f"{root}/events", f"{root}/checkpoint"
    )
    runs.finish(query)
    return read_table(spark, f"{root}/events", USER_EVENTS)


def raw_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    root, wire = _wire_folder(spark, wire_raw_events(spark, sf_dir), "raw-stream")
    runs.finish(runs.start_raw_ingest(wire, f"{root}/events", f"{root}/checkpoint"))
    return _comparable(read_table(spark, f"{root}/events", RAW_EVENTS), "amount")


def _batched(records: DataFrame, folder: str, batches: int = 4) -> int:
    """Write records as the files of a stream; how many of them make up one of its micro-batches.

    There are more files the more records there are, and the more tasks read them, so no task gets all of
    a micro-batch.
    """
    each = max(1, records.rdd.getNumPartitions(), -(-records.count() // (batches * _FILE_RECORDS)))
    records.repartition(batches * each).write.parquet(folder)
    return each


def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that came in four micro-batches, after two of their days have been put together."""
    prepare(spark)
    root = scratch_dir(spark, "compacted")
    each = _batched(wire_events(spark, sf_dir), f"{root}/wire")
    wire = file_stream(spark, f"{root}/wire", "parquet", max_files_per_trigger=each)
    runs.finish(runs.start_event_ingest(wire, products(spark, sf_dir), f"{root}/events", f"{root}/checkpoint"))
    for day in ("2024-01-15", "2024-01-16"):
        compact_day(spark, f"{root}/events", day, USER_EVENTS)
    return read_table(spark, f"{root}/events", USER_EVENTS)


# --- quality --------------------------------------------------------------------------------


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.report(user_events(spark, sf_dir), HEALTHY_TYPES)


def dq_metrics_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    target = scratch_dir(spark, "quality-log")
    checks = quality.report(user_events(spark, sf_dir), HEALTHY_TYPES)
    for run_date in ("2024-01-30", "2024-01-31"):
        append(quality.metrics_log(checks, run_date), target)
    return read_table(spark, target, QUALITY_METRICS).drop("created_at")


def dq_report_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks from counts kept by day, after one day has been replaced and only that day read again."""
    prepare(spark)
    layout = FolderLayout(scratch_dir(spark, "quality-states"))
    facts = user_events(spark, sf_dir).drop("category")
    place, levels = layout.place(EVENTS), USER_EVENTS_PARTITIONS
    append(facts, place, levels)
    days = [row["dt"] for row in facts.select("dt").distinct().collect()]
    daily.refresh_states(spark, layout, days, HEALTHY_TYPES)
    corrected = facts.where((F.col("dt") == "2024-01-15") & (F.col("event_type") != "error"))
    overwrite_day(corrected, place, "2024-01-15", partition_by=levels[1:])
    daily.refresh_states(spark, layout, ["2024-01-15"], HEALTHY_TYPES)
    return daily.report_from_states(spark, layout)


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(dq_report(spark, sf_dir))


# --- dimensions -----------------------------------------------------------------------------


def product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _comparable(dimensions.product_summary(products(spark, sf_dir)), "base_price")


def customer_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ids = given(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return dimensions.customer_rows(ids)


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers known from events, then those who ordered and are not there yet."""
    prepare(spark)
    target = scratch_dir(spark, "customers")
    seen = given(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("user_id"))
    known = dimensions.customer_rows(seen.distinct())
    append(dimensions.with_defaults(known, dimensions.customer_defaults()), target)
    user_id = F.col("o_custkey").cast("int")
    ordered = given(spark, sf_dir, "orders").select(
        user_id.alias("user_id"), bands.customer_email(user_id).alias("email")
    )
    existing = read_table(spark, target, CUSTOMERS)
    added = dimensions.rows_to_insert(
        existing, ordered, ["user_id"], ["user_id"], dimensions.customer_defaults()
    )
    append(added, target)
    return read_table(spark, target, CUSTOMERS).drop("joined_at")


def serial_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products numbered on insert, in the order of their names: parts and suppliers on top of the catalog."""
    prepare(spark)
    names = given(spark, sf_dir, "part").select(F.col("p_name").alias("name"))
    names = names.unionByName(given(spark, sf_dir, "supplier").select(F.col("s_name").alias("name")))
    added = dimensions.rows_to_insert(
        products(spark, sf_dir), names, ["name"], ["name"], dimensions.product_defaults(), serial="product_id"
    )
    return added.select(
        F.col("product_id").cast("long").alias("product_id"), "name", "category", F.col("stock").cast("long").alias("stock")
    )


# --- sinks ----------------------------------------------------------------------------------


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the second half of the month again without errors."""
    prepare(spark)
    target = scratch_dir(spark, "hourly")
    facts = _facts(spark, sf_dir)
    overwrite_partitions(marts.hourly_counts(facts), target, MART_PARTITIONS)
    corrected = facts.filter((F.col("dt") >= "2024-01-16") & (F.col("event_type") != "error"))
    overwrite_partitions(marts.hourly_counts(corrected), target, MART_PARTITIONS)
    return read_table(spark, target, HOURLY_COUNTS)


# --- metrics --------------------------------------------------------------------------------


def _broker_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = message_counters(spark, sf_dir)
    return metrics.with_labels(
        metrics.select_series(samples, "messages_total", job="broker"), "topic"
    )


def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per second over all topics: the last hour, every half hour."""
    prepare(spark)
    return metrics.total_rate(_broker_counters(spark, sf_dir), ["topic"], 3600, 1800)


def counter_rate_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rates = metrics.counter_rate(_broker_counters(spark, sf_dir), ["topic"], 3600, 3600)
    return rates.drop("increase")


def lag_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    samples = metrics.select_series(
        consumer_lags(spark, sf_dir), "consumergroup_lag", consumergroup="F"
    )
    lags = metrics.with_labels(samples, "consumergroup", "topic", "client", "sequence")
    order = metrics.sample_order(F.col("ts"), F.col("sequence").cast("long"))
    return metrics.lag_by(lags, ["consumergroup", "topic", "client"], "topic", order)


def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    samples = given(spark, sf_dir, "events").select(
        "event_type", "ts", "event_id", F.expr("nullif(value, 0)").alias("value")
    )
    order = metrics.sample_order(F.col("ts"), F.col("event_id"))
    return metrics.latest_panel(metrics.latest(samples, ["event_type"], order))


def _sample_stream(spark: SparkSession, samples: DataFrame, root: str) -> DataFrame:
    """Samples as a stream of four micro-batches."""
    each = _batched(samples, f"{root}/samples")
    return spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", each).parquet(f"{root}/samples")


def latest_value_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest values as they stand when the stream of samples has been read."""
    prepare(spark)
    root = scratch_dir(spark, "latest-stream")
    samples = given(spark, sf_dir, "events").select(
        "event_type", "ts", "event_id", F.expr("nullif(value, 0)").alias("value")
    )
    stream = _sample_stream(spark, samples, root)
    live.start_newest(stream, f"{root}/newest", f"{root}/checkpoint", ["event_type"], "event_id").awaitTermination()
    return metrics.latest_panel(read_table(spark, f"{root}/newest", samples.schema).drop("event_id"))


def lag_by_topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags by topic as they stand when the stream of samples has been read."""
    prepare(spark)
    root = scratch_dir(spark, "lag-stream")
    chosen = metrics.select_series(consumer_lags(spark, sf_dir), "consumergroup_lag", consumergroup="F")
    labels = metrics.with_labels(chosen, "consumergroup", "topic", "client", "sequence")
    samples = labels.withColumn("sequence", F.col("sequence").cast("long"))
    stream, series = _sample_stream(spark, samples, root), ["consumergroup", "topic", "client"]
    live.start_newest(stream, f"{root}/newest", f"{root}/checkpoint", series, "sequence", buckets=8).awaitTermination()
    newest = read_table(spark, f"{root}/newest", samples.schema)
    return metrics.lag_by(newest, series, "topic", metrics.sample_order(F.col("ts"), F.col("sequence")))


def events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return metrics.throughput(given(spark, sf_dir, "events"), "ts")


def events_per_minute_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that are closed when the stream has been read."""
    prepare(spark)
    root = scratch_dir(spark, "throughput")
    source = spark.readStream.schema(given(spark, sf_dir, "events").schema).parquet(
        f"{sf_dir}/events.parquet*"
    )
    query = runs.start_throughput(source, "ts", f"{root}/minutes", f"{root}/checkpoint", "10 minutes")
    query.awaitTermination()
    return read_table(spark, f"{root}/minutes")


# --- daily run ------------------------------------------------------------------------------


def source_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    records = given(spark, sf_dir, "events")
    answers = {
        "any_record": daily.source_ready(records),
        "after_mid_month": daily.source_ready(records, "ts", "2024-01-15 00:00:00"),
        "after_month": daily.source_ready(records, "ts", "2024-02-01 00:00:00"),
    }
    return spark.range(1).select(*[F.lit(answer).alias(name) for name, answer in answers.items()])


def source_ready_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three probes: of the first half of the month, of all of it, and when nothing has come since."""
    prepare(spark)
    records = given(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias(ARRIVED))
    first_half = records.where(F.col(ARRIVED) < "2024-01-15 00:00:00")
    folder = scratch_dir(spark, "high-water")
    seen = []
    for there in (first_half, records, records):
        source = HighWater(spark, folder, lambda mark, there=there: there)
        ready = source.probe()
        source.keep()
        seen.append((len(seen) + 1, ready, source.mark()))
    return spark.createDataFrame(seen, "probe int, ready boolean, mark timestamp")


def late_days_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue mart after rows of the first half of the month came late and only its days were built again."""
    return _late_rows(spark, sf_dir, "late-days", keep_measures=False)


def marts_from_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from measures kept of each micro-batch, without reading the events of a day again."""
    return _late_rows(spark, sf_dir, "kept-measures", keep_measures=True)


def _late_rows(spark: SparkSession, sf_dir: str, purpose: str, keep_measures: bool) -> DataFrame:
    prepare(spark)
    root = scratch_dir(spark, purpose)
    layout = FolderLayout(root)
    late = (F.get_json_object(F.col("value").cast("string"), "$.ts") < "2024-01-16") & (F.xxhash64("value") % 4 == 0)
    is_late = F.coalesce(late, F.lit(False))
    for part in (~is_late, is_late):
        wire_events(spark, sf_dir).where(part).write.mode("append").parquet(f"{root}/wire")
        daily.run_daily(
            spark,
            file_stream(spark, f"{root}/wire", "parquet"),
            products(spark, sf_dir),
            layout,
            run_date="2024-01-31",
            valid_types=(*HEALTHY_TYPES, "error"),
            touched=True,
            keep_measures=keep_measures,
            # The result is the mart of all events, whatever the checks say of them.
            enforced=False,
        )
    return layout.read(spark, REVENUE)


def daily_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts built from one scan and written; the result is the revenue mart."""
    prepare(spark)
    layout = FolderLayout(scratch_dir(spark, "daily-marts"))
    daily.build_marts(user_events(spark, sf_dir), products(spark, sf_dir), layout)
    return layout.read(spark, REVENUE)


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over all days: the revenue mart it leaves behind.

    Where the quality gate stops the run there is no mart, and the result is empty.
    """
    prepare(spark)
    root, wire = _wire_folder(spark, wire_events(spark, sf_dir), "daily-run")
    layout = FolderLayout(root)
    try:
        daily.run_daily(
            spark,
            wire,
            products(spark, sf_dir),
            layout,
            run_date="2024-01-31",
            ready=daily.source_ready(given(spark, sf_dir, "events")),
            valid_types=(*HEALTHY_TYPES, "error"),
        )
    except quality.QualityGateError:
        return spark.createDataFrame([], REVENUE.schema)
    return layout.read(spark, REVENUE)
