"""Data quality checks of the fact table, computed in one pass, and the gate built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemart.schemas import EVENT_TYPES, PURCHASE, QUALITY_STATES

# Names and thresholds of the checks.
ROW_COUNT_CHECK = "row_count >= 1"
USER_ID_CHECK = "user_id completeness >= 0.99"
EVENT_TYPE_CHECK = "event_type completeness >= 0.99"
PURCHASE_CHECK = "purchase amount > 0"
VALID_TYPE_CHECK = "event_type in valid set"
MIN_ROWS = 1
MIN_RATIO = 0.99
ALL_PURCHASES = 1.0

# The two outcomes of a check, and the text for a missing threshold.
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"
NO_THRESHOLD = "N/A"


class QualityGateError(RuntimeError):
    """Raised when checks failed; `failed` has their names."""

    def __init__(self, failed: Sequence[str]):
        self.failed = list(failed)
        super().__init__(f"the events fail {len(self.failed)} of their checks: {', '.join(self.failed)}")


def _counts(valid_types: Sequence[str]) -> list[Column]:
    """NULL event types are incomplete but not invalid, and NULL amounts are not bad amounts."""
    event_type, amount = F.col("event_type"), F.col("amount")
    is_purchase = event_type == PURCHASE
    return [
        F.count("*").alias("total"),
        F.count_if(F.col("user_id").isNull()).alias("null_users"),
        F.count_if(event_type.isNull()).alias("null_types"),
        F.count_if(is_purchase).alias("purchases"),
        F.count_if(is_purchase & (amount <= 0)).alias("bad_amounts"),
        F.count_if(~event_type.isin(*valid_types)).alias("invalid_types"),
    ]


def profile(events: DataFrame, valid_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """All counts the checks need, as one row from one scan of three columns."""
    return events.agg(*_counts(valid_types))


def daily_profile(events: DataFrame, valid_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """The same counts for every day: states that can be kept, replaced day by day and added up."""
    return events.groupBy("dt").agg(*_counts(valid_types)).select(*QUALITY_STATES.fieldNames())


def summed_profile(states: DataFrame) -> DataFrame:
    """The counts of all days together; without any day they are 0."""
    names = [name for name in QUALITY_STATES.fieldNames() if name != "dt"]
    return states.agg(*[F.coalesce(F.sum(name), F.lit(0).cast("long")).alias(name) for name in names])


def _share_without(bad: str, total: Column) -> Column:
    return F.lit(1.0) - F.col(bad) / F.greatest(total, F.lit(1))


def _check(name: str, passed: Column, value: Column, threshold: float) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(passed, SUCCESS).otherwise(FAILURE).alias("status"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
    )


def report(
    events: DataFrame, valid_types: Sequence[str] = EVENT_TYPES, min_rows: int = MIN_ROWS
) -> DataFrame:
    """One row per check, from one scan of the events."""
    return report_of(profile(events, valid_types), min_rows)


def report_of(counts: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per check from the counts of a profile. Without any purchase there is no purchase check.

    Values are rounded for display; the status follows the exact ratio.
    """
    total = F.col("total")
    ratios = [
        (USER_ID_CHECK, _share_without("null_users", total), MIN_RATIO),
        (EVENT_TYPE_CHECK, _share_without("null_types", total), MIN_RATIO),
        (PURCHASE_CHECK, _share_without("bad_amounts", F.col("purchases")), ALL_PURCHASES),
        (VALID_TYPE_CHECK, _share_without("invalid_types", total), MIN_RATIO),
    ]
    checks = [_check(ROW_COUNT_CHECK, total >= min_rows, total, min_rows)]
    checks += [
        _check(name, ratio >= threshold, F.round(ratio, 4), threshold)
        for name, ratio, threshold in ratios
    ]
    rows = counts.select("purchases", F.inline(F.array(*checks)))
    has_purchases = F.col("purchases") > 0
    return rows.filter((F.col("check_name") != PURCHASE_CHECK) | has_purchases).drop("purchases")


def _ratio_text(ratio: Column) -> Column:
    """Plain decimal text with at least one and at most four decimals."""
    return F.regexp_replace(ratio.cast("decimal(5,4)").cast("string"), r"(\.\d+?)0+$", "$1")


def metrics_log(checks: DataFrame, run_date: str) -> DataFrame:
    """The report as text rows of a run, ready to append to the quality log."""
    is_count = F.col("check_name") == ROW_COUNT_CHECK

    def text(name: str) -> Column:
        number = F.col(name)
        return F.when(is_count, number.cast("long").cast("string")).otherwise(_ratio_text(number))

    threshold = F.when(F.col("threshold") == 0, NO_THRESHOLD).otherwise(text("threshold"))
    return checks.select(
        F.lit(run_date).alias("run_date"),
        "check_name",
        "status",
        text("value").alias("value"),
        threshold.alias("threshold"),
        F.current_timestamp().alias("created_at"),
    )


def verdict(checks: DataFrame) -> DataFrame:
    """One row: whether all checks passed, and the names of those that did not."""
    failed = F.col("status") == FAILURE
    names = F.sort_array(F.collect_list(F.when(failed, F.col("check_name"))))
    return checks.agg(
        (F.count_if(failed) == 0).alias("passed"), F.array_join(names, ", ").alias("failed_checks")
    )


def describe(checks: DataFrame) -> str:
    """The report for reading; it has five rows at most."""

    def number(row: Row, name: str) -> str:
        return f"{row[name]:.0f}" if row["check_name"] == ROW_COUNT_CHECK else f"{row[name]:g}"

    rows = checks.collect()
    passed = sum(row["status"] == SUCCESS for row in rows)
    lines = [
        f"{'ok  ' if row['status'] == SUCCESS else 'FAIL'} {row['check_name']}: "
        f"found {number(row, 'value')}, wanted at least {number(row, 'threshold')}"
        for row in rows
    ]
    return "\n".join([f"{passed} of {len(rows)} checks of the events passed", *lines])


def enforce(checks: DataFrame) -> None:
    """Raise `QualityGateError` unless every check passed."""
    failed = checks.filter(F.col("status") == FAILURE).select("check_name").collect()
    if failed:
        raise QualityGateError(sorted(row["check_name"] for row in failed))
