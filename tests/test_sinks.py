from __future__ import annotations

import pytest
from fixtures import facts, plan
from pyspark.errors import AnalysisException

from tidemart.operators import marts
from tidemart.schemas import (
    DAILY_REVENUE, HOURLY_COUNTS, PRODUCTS, REVENUE_BY_CATEGORY, TOP_PRODUCTS, USER_EVENTS,
)
from tidemart.sinks.jdbc import append_jdbc, jdbc_write_options
from tidemart.sinks.tables import append, ensure_namespace, ensure_table, overwrite_partitions
from tidemart.sources.federation import federated_query, register_views
from tidemart.sources.jdbc import JdbcSplit, jdbc_options, read_jdbc
from tidemart.sources.streams import kafka_options, kafka_stream
from tidemart.sources.tables import catalog_table, partition_scan, read_documents, read_table


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), HOURLY_COUNTS)


def test_overwrite_replaces_the_days_present(spark, tmp_path):
    path = str(tmp_path / "hourly")
    first = counts(spark, ("2024-03-01", "00", "view", 1), ("2024-03-01", "05", "view", 2),
                   ("2024-03-02", "07", "view", 3))
    second = counts(spark, ("2024-03-02", "08", "view", 9))

    def stored():
        rows = read_table(spark, path, HOURLY_COUNTS).select(HOURLY_COUNTS.fieldNames())
        return {tuple(row) for row in rows.collect()}

    overwrite_partitions(first, path)
    assert stored() == {tuple(row) for row in first.collect()}
    for _ in range(2):
        overwrite_partitions(second, path)
        assert stored() == {
            ("2024-03-01", "00", "view", 1), ("2024-03-01", "05", "view", 2), ("2024-03-02", "08", "view", 9)
        }
    overwrite_partitions(second.limit(0), path)
    assert len(stored()) == 3


def test_partition_values_stay_text_and_unread_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [(1, "view", "p", 0.0, f"2024-03-0{day}", f"0{day}") for day in (1, 2, 3)]
    append(facts(spark, rows), path, ("dt", "hr"), spread=4)
    append(facts(spark, rows[:1]), path, ("dt", "hr"))
    table = read_table(spark, path, facts(spark, []).schema)
    day = partition_scan(table, "2024-03-01")
    assert [(row["dt"], row["hr"]) for row in day.collect()] == [("2024-03-01", "01")] * 2
    assert "PartitionFilters: [isnotnull(dt" in plan(day)
    assert "PushedFilters: []" in plan(day)


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "hot"
    hot = spark.range(0, 400_000, 1, 8).selectExpr(
        "id AS user_id", "uuid() AS product", "IF(id % 3 > 0, '2024-03-01', '2024-03-02') AS dt"
    )
    append(hot, str(path), ("dt",))
    assert len(list((path / "dt=2024-03-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 400_000


@pytest.mark.parametrize(
    "name, schema, partition_by",
    [
        ("user_events", USER_EVENTS, ("dt", "hr")),
        ("daily_revenue_by_category", REVENUE_BY_CATEGORY, ("dt",)),
        ("top_products_daily", TOP_PRODUCTS, ("dt",)),
        ("hourly_event_counts", HOURLY_COUNTS, ("dt",)),
        ("daily_revenue", DAILY_REVENUE, ()),
        ("products", PRODUCTS, ()),
    ],
)
def test_tables_are_created_once(spark, name, schema, partition_by):
    ensure_namespace(spark, "shop")
    for _ in range(2):
        ensure_table(spark, f"shop.{name}", schema, partition_by, properties={"format-version": "2"})
    table = catalog_table(spark, f"shop.{name}")
    kinds = {field.name: field.dataType for field in schema}
    assert {field.name: field.dataType for field in table.schema} == kinds
    spark.sql(f"INSERT INTO shop.{name} VALUES ({', '.join(['NULL'] * len(kinds))})")
    ensure_table(spark, f"shop.{name}", schema, partition_by)
    assert catalog_table(spark, f"shop.{name}").count() == 1


def test_table_location(spark, tmp_path):
    counts(spark, ("2024-03-01", "00", "view", 1)).write.parquet(str(tmp_path / "here"))
    ensure_table(spark, "located", HOURLY_COUNTS, location=str(tmp_path / "here"))
    assert catalog_table(spark, "located").count() == 1


def test_documents_with_a_declared_schema(spark, tmp_path):
    (tmp_path / "docs.json").write_text('{"_id":"a","tags":["x"],"n":1}\n{"_id":"b","other":true}\n')
    schema = spark.createDataFrame([], "_id string, tags array<string>, n int").schema
    rows = read_documents(spark, str(tmp_path), schema).collect()
    assert [tuple(row) for row in rows] == [("a", ["x"], 1), ("b", None, None)]


def test_one_statement_over_several_readers(spark, tmp_path):
    rows = [(1, "purchase", "a", 2.0, "2024-03-01", "10"), (2, "view", "a", 0.0, "2024-03-01", "10")]
    append(facts(spark, rows), str(tmp_path / "lake"))
    (tmp_path / "names.json").write_text('{"name":"a","category":"x"}\n')
    lake = read_table(spark, str(tmp_path / "lake"))
    names = spark.read.schema("name string, category string").json(str(tmp_path / "names.json"))
    statement = "SELECT category, count(*) AS n FROM {lake} JOIN {names} ON product = name GROUP BY category"
    assert [tuple(row) for row in federated_query(spark, statement, lake=lake, names=names).collect()] == [("x", 2)]
    register_views(spark, lake_events=lake)
    assert spark.sql("SELECT * FROM lake_events").count() == 2
    assert marts.top_sales(spark, marts.with_measures(lake), names).first()["revenue"] == 2.0


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "products", {"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "products", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "t", split=JdbcSplit("id", "1", "1000", 16))
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "16"
    assert (split["lowerBound"], split["upperBound"]) == ("1", "1000")
    written = jdbc_write_options("jdbc:x", "log", {"user": "u"}, {"run_date": "VARCHAR(10)", "value": "VARCHAR(20)"})
    assert written["createTableColumnTypes"] == "run_date VARCHAR(10), value VARCHAR(20)"
    assert written["numPartitions"] == "8" and written["user"] == "u"


def test_jdbc_and_kafka_reach_their_sources(spark):
    """Without a driver or package on this machine the source itself reports what is missing."""
    with pytest.raises(Exception, match="No suitable driver"):
        read_jdbc(spark, "jdbc:nothing:here", "products", ["name", "category"])
    with pytest.raises(Exception, match="No suitable driver"):
        append_jdbc(spark.range(1), "jdbc:nothing:here", "log", properties={"user": "u"})
    with pytest.raises(AnalysisException, match="[Kk]afka"):
        kafka_stream(spark, "nowhere:9092", "user_events", fail_on_data_loss=False)


def test_kafka_options():
    assert kafka_options("k:9092", "user_events", fail_on_data_loss=False) == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "user_events",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    bounded = kafka_options("k:9092", "t", "earliest", max_offsets_per_trigger=5, min_partitions=64)
    assert bounded["startingOffsets"] == "earliest" and bounded["failOnDataLoss"] == "true"
    assert bounded["maxOffsetsPerTrigger"] == "5" and bounded["minPartitions"] == "64"
