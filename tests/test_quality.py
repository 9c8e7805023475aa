from __future__ import annotations

import pytest
from fixtures import facts, plan

from tidemart.operators import quality
from tidemart.schemas import QUALITY_METRICS


def rows(*pairs):
    """Facts from (user_id, event_type, amount)."""
    return [(user, kind, "p", amount, "2024-03-01", "10") for user, kind, amount in pairs]


def checked(spark, *pairs, **settings):
    report = quality.report(facts(spark, rows(*pairs)), **settings)
    return {row["check_name"]: (row["status"], row["value"], row["threshold"]) for row in report.collect()}


def test_healthy_events(spark):
    got = checked(spark, (1, "purchase", 9.99), (2, "view", 0.0))
    assert got == {
        quality.ROW_COUNT_CHECK: ("SUCCESS", 2.0, 1.0),
        quality.USER_ID_CHECK: ("SUCCESS", 1.0, 0.99),
        quality.EVENT_TYPE_CHECK: ("SUCCESS", 1.0, 0.99),
        quality.PURCHASE_CHECK: ("SUCCESS", 1.0, 1.0),
        quality.VALID_TYPE_CHECK: ("SUCCESS", 1.0, 0.99),
    }


def test_empty_table_fails_the_row_count_only(spark):
    got = checked(spark)
    assert len(got) == 4
    assert [name for name, row in got.items() if row[0] == "FAILURE"] == [quality.ROW_COUNT_CHECK]


def test_no_purchases_no_purchase_check(spark):
    assert quality.PURCHASE_CHECK not in checked(spark, (1, "view", 0.0))


def test_missing_event_type_is_incomplete_but_not_invalid(spark):
    got = checked(spark, (1, None, 0.0), (2, "view", 0.0))
    assert got[quality.EVENT_TYPE_CHECK] == ("FAILURE", 0.5, 0.99)
    assert got[quality.VALID_TYPE_CHECK][0] == "SUCCESS"


def test_missing_user(spark):
    assert checked(spark, (None, "view", 0.0))[quality.USER_ID_CHECK] == ("FAILURE", 0.0, 0.99)


@pytest.mark.parametrize("amount, status", [(0.0, "FAILURE"), (-1.0, "FAILURE"), (None, "SUCCESS")])
def test_purchase_amounts(spark, amount, status):
    got = checked(spark, (1, "purchase", amount), (2, "purchase", 5.0))
    assert got[quality.PURCHASE_CHECK][0] == status


@pytest.mark.parametrize("bad, status", [(0, "SUCCESS"), (1, "SUCCESS"), (2, "FAILURE")])
def test_thresholds(spark, bad, status):
    pairs = [(1, "view", 0.0)] * (100 - bad) + [(1, "other", 0.0)] * bad
    assert checked(spark, *pairs)[quality.VALID_TYPE_CHECK] == (status, 1 - bad / 100, 0.99)


def test_status_follows_the_exact_ratio(spark):
    frame = spark.range(100_000).selectExpr(
        "id AS user_id", "'purchase' AS event_type", "CASE WHEN id = 0 THEN 0D ELSE 1D END AS amount"
    )
    row = quality.report(frame).filter(f"check_name = '{quality.PURCHASE_CHECK}'").first()
    assert (row["status"], row["value"]) == ("FAILURE", 1.0)


def test_other_valid_types_and_row_minimum(spark):
    got = checked(spark, (1, "signup", 0.0), valid_types=["signup"], min_rows=2)
    assert got[quality.VALID_TYPE_CHECK][0] == "SUCCESS"
    assert got[quality.ROW_COUNT_CHECK] == ("FAILURE", 1.0, 2.0)


def test_log_rows_are_text(spark):
    pairs = [(1, "view", 0.0)] * 7 + [(None, None, 0.0)] * 2
    report = quality.report(facts(spark, rows(*pairs)))
    log = quality.metrics_log(report, "2024-03-01")
    assert [(f.name, f.dataType) for f in log.schema] == [(f.name, f.dataType) for f in QUALITY_METRICS]
    texts = {row["check_name"]: (row["value"], row["threshold"]) for row in log.collect()}
    assert texts[quality.ROW_COUNT_CHECK] == ("9", "1")
    assert texts[quality.USER_ID_CHECK] == ("0.7778", "0.99")
    assert texts[quality.VALID_TYPE_CHECK] == ("1.0", "0.99")
    assert {row["run_date"] for row in log.collect()} == {"2024-03-01"}
    none = quality.metrics_log(quality.report(facts(spark, rows()), min_rows=0), "2024-03-01")
    assert none.filter(f"check_name = '{quality.ROW_COUNT_CHECK}'").first()["threshold"] == "N/A"


def test_gate(spark):
    good = quality.report(facts(spark, rows((1, "view", 0.0))))
    quality.enforce(good)
    assert tuple(quality.verdict(good).first()) == (True, "")
    bad = quality.report(facts(spark, rows((None, None, 0.0))))
    with pytest.raises(quality.QualityGateError) as error:
        quality.enforce(bad)
    assert error.value.failed == [quality.EVENT_TYPE_CHECK, quality.USER_ID_CHECK]
    assert tuple(quality.verdict(bad).first()) == (False, ", ".join(error.value.failed))
    assert "FAIL user_id completeness" in quality.describe(bad)


def test_all_counts_come_from_one_aggregate(spark):
    text = plan(quality.report(facts(spark, rows((1, "view", 0.0)))))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_large_counts_are_written_out(spark):
    rows = spark.createDataFrame(
        [(quality.ROW_COUNT_CHECK, "SUCCESS", 1234567890120.0, 1.0), (quality.PURCHASE_CHECK, "FAILURE", 0.9876, 1.0)],
        "check_name string, status string, value double, threshold double",
    )
    text = quality.describe(rows)
    assert "found 1234567890120, wanted at least 1" in text and "found 0.9876" in text
