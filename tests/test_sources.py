"""Readers, writers and the governed SQL entry point."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from holdfast.operators import marts
from holdfast.schemas import table_schema
from holdfast.sources import documents, governed_sql, reports, sinks, tables


def test_csv_folder(spark, tmp_path):
    (tmp_path / "dim_channel.csv").write_text(
        "channel_id,channel_code,channel_name,channel_family,is_digital,is_inbound\nCH_WEB,WEB,,DIGITAL,true,false\n"
    )
    loaded = tables.read_csv_folder(spark, str(tmp_path))
    assert list(loaded) == ["dim_channel"]
    row = loaded["dim_channel"].first()
    assert row.channel_name is None and row.is_digital is True
    with pytest.raises(FileNotFoundError):
        tables.read_csv_folder(spark, str(tmp_path / "absent"))


def test_relational_read_asks_for_ranges(spark):
    with pytest.raises(TypeError, match="partition_column"):
        tables.read_jdbc(spark, "jdbc:none://", "orders")
    with pytest.raises(ValueError, match="partitions"):
        tables.read_jdbc(spark, "jdbc:none://", "orders", partition_column="id", lower=0, upper=9, partitions=1)


def test_documents(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "plan_un.md").write_text("intro\n  ## Sinistre recent \nbody")
    (tmp_path / "prix élevé +1% a.md").write_text("x")
    (tmp_path / "note_deux.txt").write_text("plain text")
    (tmp_path / "blank.md").write_text("  \n ")
    (tmp_path / "other.csv").write_text("x")
    got = {r.document_id: r.title for r in documents.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"plan_un": "Sinistre recent", "note_deux": "Note Deux", "prix élevé +1% a": "Prix Élevé +1% A"}
    assert documents.read_documents(spark, str(tmp_path / "absent")).count() == 0


def test_governed_sql(spark):
    spark.range(500).createOrReplaceTempView("holdfast_numbers")
    result = governed_sql.query(spark, "SELECT id FROM holdfast_numbers WHERE id >= :low;", {"low": 10}, limit=200)
    assert result.counted() == (200, True)
    assert governed_sql.query(spark, "SELECT id FROM holdfast_numbers", limit=500).counted() == (500, False)
    with pytest.raises(ValueError, match="positive"):
        governed_sql.query(spark, "SELECT 1", limit=0)
    assert governed_sql.query(spark, "SELECT id FROM holdfast_numbers LIMIT 400", limit=50).counted() == (50, True)
    for text, message in (
        ("DELETE FROM x", "SELECT or WITH"), ("SELECT 1; DROP TABLE x", "Unsafe SQL keyword"), ("SELECT 1; SELECT 2", "one SQL statement"),
        ("SELECT replace(a, 'b', 'c') FROM t", "Unsafe SQL keyword"), ("", "SELECT or WITH"),
    ):
        with pytest.raises(ValueError, match=message):
            governed_sql.query(spark, text, limit=10)


def test_upsert_keeps_unreplaced_columns(spark, tmp_path):
    schema = table_schema("churn_prediction")
    row = (dt.date(2026, 6, 30), "C1", "test", "0.100000", 0, "LOW", "m", "1", "r", dt.datetime(2026, 7, 1))
    fields = "observation_date DATE, customer_id STRING, split_name STRING, churn_probability STRING, predicted_churn_label INT, churn_risk_band STRING, model_name STRING, model_version STRING, mlflow_run_id STRING, scored_at TIMESTAMP"
    first = spark.createDataFrame([row, (*row[:1], "C2", "backtest", *row[3:])], fields)
    root = str(tmp_path / "predictions")
    sinks.upsert_predictions(spark, first, root)
    update = spark.createDataFrame([(*row[:3], "0.900000", 1, "HIGH", "m", "2", "r", dt.datetime(2026, 8, 1)), (*row[:1], "C3", *row[2:])], fields)
    sinks.upsert_predictions(spark, update, root)
    got = {r.customer_id: r for r in sinks.read_predictions(spark, root).collect()}
    assert set(got) == {"C1", "C2", "C3"} and set(got["C1"].asDict()) == set(schema.fieldNames())
    assert (float(got["C1"].churn_probability), got["C1"].model_version, got["C1"].scored_at) == (0.9, "1", dt.datetime(2026, 8, 1))


def test_reports_and_records(spark, tmp_path):
    assert reports.read_importance(spark, str(tmp_path / "none")).count() == 0
    rows = spark.createDataFrame([("CUST_000001", 0.8734, None)], "customer_id STRING, score DOUBLE, missing STRING")
    assert json.loads(sinks.json_records(rows).first().record) == {"customer_id": "CUST_000001", "score": 0.8734, "missing": None}
    sinks.append_audit(sinks.audit_row(spark, "b1", "reset", {"seed": 1, "n_customers": 2}), str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).first().status == "SUCCEEDED"


def test_calendar(spark):
    days = tables.calendar(spark, dt.date(2020, 1, 1), dt.date(2026, 9, 28))
    assert days.count() == 2463
    end = days.filter(F.col("calendar_date") == dt.date(2024, 12, 31)).first()
    assert (end.date_key, end.day_of_week, end.week_of_year, end.is_year_end, end.month_name) == (20241231, 2, 1, True, "December")


def test_upsert_survives_failed_and_competing_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "predictions")
    row = spark.createDataFrame(
        [("2025-01-01", "c1", "test", 0.5, 1, "HIGH", "m", "1", "run", None)],
        "observation_date STRING, customer_id STRING, split_name STRING, churn_probability DOUBLE, predicted_churn_label INT, "
        "churn_risk_band STRING, model_name STRING, model_version STRING, mlflow_run_id STRING, scored_at TIMESTAMP",
    )
    first = sinks.upsert_predictions(spark, row, root)
    (tmp_path / "predictions" / "_claims" / "00000001").write_text("")  # left by a writer that failed
    assert sinks.upsert_predictions(spark, row, root).endswith("version=00000002")
    real = sinks.current_version
    seen = iter([real(spark, root), first])
    monkeypatch.setattr(sinks, "current_version", lambda *_: next(seen))
    with pytest.raises(RuntimeError, match="Another writer"):
        sinks.upsert_predictions(spark, row, root)
    monkeypatch.undo()
    assert real(spark, root).endswith("version=00000002") and sinks.read_predictions(spark, root).count() == 1
    sinks.upsert_predictions(spark, row, root)
    assert len(list((tmp_path / "predictions").glob("version=*"))) <= 3


def test_upsert_rewrites_touched_splits_only_and_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "predictions")
    fields = (
        "observation_date STRING, customer_id STRING, split_name STRING, churn_probability DOUBLE, predicted_churn_label INT, "
        "churn_risk_band STRING, model_name STRING, model_version STRING, mlflow_run_id STRING, scored_at TIMESTAMP"
    )
    row = lambda customer, split, p=0.5: ("2025-01-01", customer, split, p, 1, "HIGH", "m", "1", "run", None)
    frame = lambda *rows: spark.createDataFrame(list(rows), fields)
    files = lambda: {f.rsplit("/predictions/", 1)[1] for f in sinks.read_predictions(spark, root).inputFiles()}
    sinks.upsert_predictions(spark, frame(row("c1", "test"), row("c1", "backtest")), root)
    before = {f for f in files() if "backtest" in f}
    sinks.upsert_predictions(spark, frame(row("c2", "test")), root)
    assert before and before == {f for f in files() if "backtest" in f}
    real = sinks._publish

    def late(session, folder, number, text):
        monkeypatch.undo()
        sinks.upsert_predictions(session, frame(row("c3", "test")), folder)  # comes between the check and the rename
        real(session, folder, number, text)

    monkeypatch.setattr(sinks, "_publish", late)
    with pytest.raises(RuntimeError, match="Another writer"):
        sinks.upsert_predictions(spark, frame(row("c4", "validation")), root)
    got = sorted((r.customer_id, r.split_name) for r in sinks.read_predictions(spark, root).collect())
    assert got == [("c1", "backtest"), ("c1", "test"), ("c2", "test"), ("c3", "test")]
    sinks.upsert_predictions(spark, frame(row("c4", "validation")), root)
    assert sinks.read_predictions(spark, root).count() == 5


def test_latest_run_opens_only_its_own_files(spark, tmp_path):
    root = str(tmp_path / "predictions")
    fields = (
        "observation_date STRING, customer_id STRING, split_name STRING, churn_probability DOUBLE, predicted_churn_label INT, "
        "churn_risk_band STRING, model_name STRING, model_version STRING, mlflow_run_id STRING, scored_at TIMESTAMP"
    )
    names = ["007", "run b", "2024-01-01", "x=y/z"]  # ids that look like numbers or dates, or need escaping, stay text
    for hour, run in enumerate(names):
        rows = [("2025-01-01", f"c{i}", split, 0.5, 1, "HIGH", "m", "1", run, dt.datetime(2026, 1, 1, hour)) for i in range(5) for split in ("test", "backtest")]
        before = set(sinks.read_predictions(spark, root).inputFiles())
        sinks.upsert_predictions(spark, spark.createDataFrame(rows, fields), root)
        assert before <= set(sinks.read_predictions(spark, root).inputFiles())
    stored = sinks.read_predictions(spark, root)
    assert stored.count() == 40 and {r[0] for r in stored.select("mlflow_run_id").distinct().collect()} == set(names)
    latest = marts.of_latest_run(stored)
    assert {(r.mlflow_run_id, r.split_name) for r in latest.collect()} == {("x=y/z", "test"), ("x=y/z", "backtest")} and latest.count() == 10
    plan = latest._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(mlflow_run_id" in plan.toString() and "Subquery" in plan.toString()

    def scans(node):
        node = node.finalPhysicalPlan() if "AdaptiveSparkPlan" in node.nodeName() else node
        if "Scan parquet" in node.nodeName():
            yield node.metrics()
        for i in range(node.children().size()):
            yield from scans(node.children().apply(i))

    (metrics,) = scans(plan)
    own = [f for f in stored.inputFiles() if "x%3Dy" in f or "x%253Dy" in f]
    assert 0 < metrics.get("numFiles").get().value() == len(own) < len(stored.inputFiles())
    assert metrics.get("numPartitions").get().value() == 2
