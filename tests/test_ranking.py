from __future__ import annotations

import random

import pytest
from fixtures import facts
from pyspark.sql import functions as F

from tidemart.operators import marts, ranking
from tidemart.operators.ranking import ranked


def expected(rows, group, key):
    """Rows with their place among those of their group, told by sorting all of them."""
    found, places = [], {}
    for row in sorted(rows, key=lambda row: (group(row), key(row))):
        places[group(row)] = places.get(group(row), 0) + 1
        found.append((*row, places[group(row)]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("pieces", [None, 1, 5, 40])
def test_ranks_equal_a_sort_of_everything(spark, pieces):
    draw = random.Random(3)
    # One group has two thirds of the rows, one has no name, and one lies in a single piece.
    rows = [(draw.choice(["hot"] * 6 + ["a", None, "b"]), i, draw.random()) for i in range(3000)] + [("last", -1, 0.5)]
    frame = spark.createDataFrame(rows, "g string, id long, x double").repartition(7)
    got = ranked(frame, ["g"], [F.col("x").desc(), "id"], pieces=pieces)
    assert got.columns == ["g", "id", "x", "rank"] and dict(got.dtypes)["rank"] == "bigint"
    wanted = expected(rows, lambda row: row[0] or "", lambda row: (-row[2], row[1]))
    assert sorted((tuple(row) for row in got.collect()), key=repr) == wanted


def test_without_groups(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"))
    rows = ranked(frame, [], ["id"], "n", pieces=16).collect()
    assert all(row["n"] == row["id"] + 1 for row in rows) and len(rows) == 5000
    assert ranked(frame.limit(0), [], ["id"], "n").columns == ["id", "n"]
    assert ranked(frame.limit(0), [], ["id"], "n").count() == 0


def test_a_hot_group_of_equal_rows_is_cut_into_pieces(spark, monkeypatch):
    written = []
    kept = ranking.checkpointed
    monkeypatch.setattr(ranking, "checkpointed", lambda frame: written.append(kept(frame)) or written[-1])
    frame = spark.range(0, 20_000, 1, 8).select(F.lit("same").alias("g"), F.lit(1).alias("x"))
    got = ranked(frame, ["g"], ["x"], pieces=16)
    assert sorted(row["rank"] for row in got.collect()) == list(range(1, 20_001))
    sizes = [row["count"] for row in written[0].groupBy("_piece").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 5000


def test_rank_of_every_product(spark):
    rows = [(i, "purchase", f"p{i % 40:02d}", float(i % 40 // 4), f"2024-03-0{1 + i % 2}", "10") for i in range(400)]
    rows += [(1, "purchase", "no amount", None, "2024-03-01", "10")]
    mart = marts.top_products(marts.with_measures(facts(spark, rows)), spark.createDataFrame([], "name string, category string"))
    got = {(row["dt"], row["rank"]): (row["revenue"], row["product"]) for row in marts.with_rank(mart).collect()}
    assert len(got) == 41
    for day in ("2024-03-01", "2024-03-02"):
        listed = [got[day, rank] for rank in range(1, 1 + sum(key[0] == day for key in got))]
        assert listed == sorted(listed, key=lambda row: (row[0] is None, -(row[0] or 0), row[1]))
    assert got["2024-03-01", 21][1] == "no amount"
