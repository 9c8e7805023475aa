from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tidemart.functions import money


def summarise(spark, rows):
    frame = spark.createDataFrame(rows, "grp string, amount double")
    return {
        row["grp"]: row
        for row in frame.select("grp", *money.row_measures(F.col("amount")))
        .groupBy("grp")
        .agg(*money.summed_measures())
        .select("grp", money.EVENT_COUNT, money.total().alias("total"), money.average().alias("avg"))
        .collect()
    }


def half_up(value):
    return float(value.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_equals_decimal_arithmetic(spark):
    rng = random.Random(7)
    rows = [(f"g{i}", round(rng.uniform(-50, 2000), 2)) for i in range(300) for _ in range(rng.randint(1, 9))]
    got = summarise(spark, rows)
    for grp in {row[0] for row in rows}:
        amounts = [Decimal(repr(amount)) for name, amount in rows if name == grp]
        assert got[grp]["total"] == half_up(sum(amounts))
        assert got[grp]["avg"] == half_up(sum(amounts) / len(amounts))


def test_ties_round_away_from_zero(spark):
    got = summarise(spark, [("up", 0.01), ("up", 0.02), ("down", -0.01), ("down", -0.02)])
    assert got["up"]["avg"] == 0.02
    assert got["down"]["avg"] == -0.02


def test_more_than_two_decimals_are_rounded_once(spark):
    got = summarise(spark, [("fine", 0.004)] * 10 + [("single", 1.015)])
    assert got["fine"]["total"] == 0.04
    assert got["fine"]["avg"] == 0.0
    assert got["single"]["total"] == 1.02


def test_special_amounts_show_up(spark):
    rows = [("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 1.0)]
    rows += [("big", 1e17), ("big", 1e17), ("none", None), ("some", None), ("some", 3.0)]
    got = summarise(spark, rows)
    assert math.isnan(got["nan"]["total"]) and math.isnan(got["nan"]["avg"])
    assert got["inf"]["total"] == math.inf
    assert got["big"]["total"] == 2e17
    assert got["none"]["total"] is None and got["none"]["avg"] is None
    assert got["none"][money.EVENT_COUNT] == 1
    assert (got["some"]["total"], got["some"]["avg"], got["some"][money.EVENT_COUNT]) == (3.0, 3.0, 2)


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    rows = [("g", round(rng.uniform(0, 2000), 2)) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "grp string, amount double")

    def total(parts):
        measured = frame.repartition(parts).select("grp", *money.row_measures(F.col("amount")))
        return measured.groupBy("grp").agg(*money.summed_measures()).select(money.total()).first()[0]

    exact = half_up(sum(Decimal(repr(amount)) for _, amount in rows))
    assert {total(parts) for parts in (1, 3, 8)} == {exact}


def test_sums_beyond_a_long_of_cents(spark):
    rows = spark.range(100_000_000).select(F.lit("g").alias("grp"), F.lit(990_000_000.0).alias("amount"))
    row = (
        rows.select("grp", *money.row_measures(F.col("amount")))
        .groupBy("grp")
        .agg(*money.summed_measures())
        .select(money.total().alias("total"), money.average().alias("avg"))
        .first()
    )
    assert (row["total"], row["avg"]) == (9.9e16, 9.9e8)


def test_weights_do_not_overflow(spark):
    rows = spark.createDataFrame([("g", 9e13, 1 << 40), ("g", -0.01, 3)], "grp string, amount double, n long")
    measured = rows.select("grp", "n", *money.row_measures(F.col("amount"))).groupBy("grp")
    total = measured.agg(*money.summed_measures("n")).select(money.total().alias("total")).first()["total"]
    assert total == 9e13 * (1 << 40)
