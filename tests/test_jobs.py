from __future__ import annotations

import json

import pytest
from fixtures import catalog, event

from tidemart.plans.jobs import main, parser
from tidemart.plans.layout import TABLES, CatalogLayout


@pytest.fixture
def deployment(spark, tmp_path):
    catalog(spark).write.parquet(str(tmp_path / "products"))
    (tmp_path / "wire").mkdir()
    records = [event(i, "purchase", "mouse", 10.0, "2024-03-01T10:00:00Z") for i in range(3)]
    lines = [json.dumps(record) for record in records] + ["broken"]
    (tmp_path / "wire" / "a.txt").write_text("\n".join(lines))
    return {
        "root": ["--root", str(tmp_path / "lake")],
        "wire": ["--wire-dir", str(tmp_path / "wire")],
        "products": ["--products", str(tmp_path / "products")],
        "path": tmp_path,
    }


def test_jobs_one_by_one(spark, deployment, capsys):
    root, wire, products = deployment["root"], deployment["wire"], deployment["products"]
    assert main(["ingest", *root, *wire, *products], spark) == 0
    assert "wrote 3 events" in capsys.readouterr().out
    assert main(["raw-ingest", *root, *wire], spark) == 0
    assert "wrote 4 records" in capsys.readouterr().out
    assert main(["quality", *root, "--day", "2024-03-01"], spark) == 0
    assert "ok   purchase amount > 0" in capsys.readouterr().out
    assert main(["quality", *root, "--valid-types", "view"], spark) == 1
    captured = capsys.readouterr()
    assert "FAIL event_type in valid set" in captured.out
    assert "fail 1 of their checks" in captured.err
    assert main(["marts", "2024-03-01", *root, *products], spark) == 0
    assert main(["marts", "--all-days", *root, *products], spark) == 0
    assert main(["summary", *root, *products], spark) == 0
    assert "peripherals" in capsys.readouterr().out
    mart = deployment["path"] / "lake" / "analytics" / "hourly_event_counts"
    assert spark.read.parquet(str(mart)).first()["event_count"] == 3


def test_daily_job(spark, deployment, capsys):
    shared = [*deployment["root"], *deployment["wire"], *deployment["products"]]
    assert main(["daily", "2024-03-01", *shared], spark) == 0
    assert "ingested 3 events" in capsys.readouterr().out


def test_touched_days_and_compaction(spark, deployment, capsys):
    shared = [*deployment["root"], *deployment["wire"], *deployment["products"]]
    assert main(["daily", "--touched", *shared], spark) == 0
    assert "ingested 3 events" in capsys.readouterr().out
    mart = deployment["path"] / "lake" / "analytics" / "hourly_event_counts"
    assert spark.read.parquet(str(mart)).first()["event_count"] == 3
    assert main(["compact", "2024-03-01", *deployment["root"]], spark) == 0
    assert "put the files of 2024-03-01 together" in capsys.readouterr().out
    assert main(["compact", "2024-03-01", *deployment["root"]], spark) == 0
    assert "nothing to do" in capsys.readouterr().out
    assert main(["daily", "--touched", *shared], spark) == 0
    assert "nothing to do" in capsys.readouterr().out
    assert main(["quality", *deployment["root"]], spark) == 0


def test_setup_creates_all_tables(spark, tmp_path):
    for _ in range(2):
        assert main(["setup", "--root", str(tmp_path)], spark) == 0
    layout = CatalogLayout(str(tmp_path), table_format="parquet")
    for table in TABLES:
        assert layout.read(spark, table).schema == table.schema


def test_defaults_of_the_streams():
    ingest = parser().parse_args(["ingest", "--root", "r"])
    assert (ingest.starting_offsets, ingest.tolerant, ingest.every) == ("latest", True, None)
    raw = parser().parse_args(["raw-ingest", "--root", "r"])
    assert (raw.starting_offsets, raw.tolerant) == ("earliest", False)


def test_daily_job_without_anything_new(spark, deployment, capsys):
    shared = [*deployment["root"], *deployment["wire"], *deployment["products"]]
    log = deployment["path"] / "lake" / "quality" / "data_quality_metrics"
    assert main(["daily", "2024-03-01", *shared], spark) == 0
    assert "micro-batch 0: 3 rows" in capsys.readouterr().out
    before = spark.read.parquet(str(log)).count()
    assert main(["daily", "2024-03-01", *shared], spark) == 0
    assert "nothing to do" in capsys.readouterr().out
    assert spark.read.parquet(str(log)).count() == before
    # Another day has not been built yet, and new records are built again.
    assert main(["daily", "2024-03-02", *shared], spark) == 1
    assert main(["daily", "2024-03-02", *shared, "--check-all"], spark) == 0
    record = event(9, "purchase", "phone", 4.0, "2024-03-01T11:00:00Z")
    (deployment["path"] / "wire" / "b.txt").write_text(json.dumps(record))
    assert main(["daily", "2024-03-01", *shared], spark) == 0
    assert "ingested 1 events" in capsys.readouterr().out


def test_start_of_the_streams():
    from tidemart.plans.jobs import first_offsets

    def start(*arguments):
        return first_offsets(parser().parse_args([*arguments, "--root", "r"]))

    assert start("ingest") == "earliest"
    assert start("ingest", "--every", "60 seconds") == "latest"
    assert start("ingest", "--starting-offsets", "latest") == "latest"
    assert start("raw-ingest", "--every", "60 seconds") == "earliest"


def test_settings_of_databases(monkeypatch):
    from tidemart.plans.jobs import jdbc_split, metrics_jdbc
    from tidemart.sources.jdbc import JdbcSplit

    monkeypatch.setenv("LOG_PASSWORD", "secret")
    options = parser().parse_args(
        ["daily", "2024-03-01", "--root", "r", "--metrics-jdbc-url", "jdbc:x", "--metrics-jdbc-user", "u",
         "--metrics-jdbc-password-variable", "LOG_PASSWORD", "--jdbc-split", "product_id", "--jdbc-lower", "1",
         "--jdbc-upper", "900", "--jdbc-partitions", "9", "--spread", "64"]
    )
    assert metrics_jdbc(options) == {
        "url": "jdbc:x", "table": "data_quality_metrics", "properties": {"user": "u", "password": "secret"}
    }
    assert jdbc_split(options) == JdbcSplit("product_id", "1", "900", 9) and options.spread == 64
    plain = parser().parse_args(["quality", "--root", "r"])
    assert metrics_jdbc(plain) is None and plain.spread is None


def test_quality_log_goes_to_a_database_as_well(spark, deployment):
    root, wire, products = deployment["root"], deployment["wire"], deployment["products"]
    assert main(["ingest", *root, *wire, *products], spark) == 0
    with pytest.raises(Exception, match="No suitable driver"):
        main(["quality", *root, "--metrics-jdbc-url", "jdbc:nothing:here"], spark)
