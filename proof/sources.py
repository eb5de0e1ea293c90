"""Group A (sources and sinks). Sinks write to a scratch folder of the session's checkpoint folder and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.text import heading
from holdfast.operators import explain, marts
from holdfast.schemas import table_schema
from holdfast.session import ensure_checkpoint_dir
from holdfast.sources import documents, governed_sql, reports, sinks, tables
from proof.base import Tables, register

_KEY_SQL = "CAST(observation_date AS VARCHAR) AS observation_date, customer_id"


def _scratch(t: Tables) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/holdfast-{uuid.uuid4().hex}"


def _csv_round_trip(t: Tables) -> DataFrame:
    """Labels written as declared CSV and scanned back with the declared schema."""
    path = _scratch(t)
    fields = table_schema("churn_label").fields
    sinks.write_csv(t.labels.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]), path)
    return tables.read_csv(t.spark, path, "churn_label")


register("a01_csv_scan", _csv_round_trip, f"""
SELECT {_KEY_SQL}, split_name, prediction_horizon_days, churn_label, CAST(churn_date AS VARCHAR) AS churn_date, customer_lifecycle_status,
  churn_probability, churn_risk_band, label_reason FROM lab""")


def _table_read(t: Tables) -> DataFrame:
    root = _scratch(t)
    sinks.refresh_table(t.labels, f"{root}/churn_label", ["split_name"])
    return tables.read_parquet(t.spark, root, "churn_label").filter("split_name = 'test'").select("customer_id", "churn_label", "split_name")


register("a03_table_read", _table_read, "SELECT customer_id, churn_label, split_name FROM lab WHERE split_name = 'test'")


def _select_in(t: Tables) -> DataFrame:
    t.labels.createOrReplaceTempView("holdfast_labels")
    wanted = ["test", "backtest"]
    return tables.select_in(t.spark, "holdfast_labels", "split_name", wanted, ["churn_probability", "customer_id", "observation_date"], 50).select(
        "observation_date", "customer_id", "split_name", "churn_probability"
    )


register("a04_parameterised_in", _select_in, f"""
SELECT {_KEY_SQL}, split_name, churn_probability FROM lab WHERE split_name IN ('test', 'backtest')
ORDER BY churn_probability, lab.customer_id, lab.observation_date LIMIT 50""")


def _titles(t: Tables) -> DataFrame:
    text = F.concat(
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("intro\n  ## Doc "), F.col("doc_id"), F.lit(" \nbody\n"))).otherwise(F.lit("")), F.regexp_replace("text", "#", ""),
    )
    return t.raw("documents").select("doc_id", heading(text, F.concat(F.lit("note_"), F.col("lang"), F.lit("_"), F.col("source"))).alias("title"))


register("a06_titles", _titles, """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Doc ' || doc_id ELSE 'Note ' || upper(lang[1]) || lower(lang[2:]) || ' ' || upper(source[1]) || lower(source[2:]) END AS title
FROM documents""")


def _document_corpus(t: Tables) -> DataFrame:
    """Passages written one to a file below folders with spaces, accents, plus and percent signs, then read as documents."""
    path = _scratch(t)
    item = F.col("item_id")
    heading_line = F.when(item % 3 == 0, F.concat(F.lit("lead\n ## Fiche "), item, F.lit(" \n"))).otherwise(F.concat(F.lit("# Note "), item, F.lit("\n")))
    body = F.when(item % 7 == 0, F.lit(" \n\t")).otherwise(F.concat(heading_line, F.regexp_replace("text", r"[#\s]+", " ")))
    t.raw("benchmark").select(F.concat(F.lit("prix élevé +"), item % 4, F.lit("% a")).alias("topic"), body.alias("value")).write.partitionBy(
        "topic").option("maxRecordsPerFile", 1).text(path)
    found = documents.read_documents(t.spark, path)
    return found.select(
        F.regexp_extract("path", "topic=([^/]*)/", 1).alias("folder"), "title", F.col("document_id").startswith("part-").alias("named"),
        F.md5(F.regexp_replace("text", r"\s+", " ")).alias("text_md5"),
    )


register("a05_document_corpus", _document_corpus, r"""
SELECT 'prix élevé +' || (item_id % 4) || '%25 a' AS folder, CASE WHEN item_id % 3 = 0 THEN 'Fiche ' ELSE 'Note ' END || item_id AS title, true AS named,
  md5(trim(CASE WHEN item_id % 3 = 0 THEN 'lead ## Fiche ' || item_id || ' ' ELSE '# Note ' || item_id || ' ' END
    || regexp_replace(text, '[#\s]+', ' ', 'g'))) AS text_md5
FROM benchmark WHERE item_id % 7 <> 0""")


def _queue_csv(t: Tables) -> DataFrame:
    path = _scratch(t)
    sinks.write_csv(t.queue, path)
    read = t.spark.read.schema(t.queue.schema).option("header", True).csv(path)
    return read.select("customer_id", "split_name", "priority_score", "business_context")


register("a08_csv_sink", _queue_csv, "SELECT customer_id, split_name, priority_score, business_context FROM queue")


def _refreshed(t: Tables) -> DataFrame:
    path = _scratch(t)
    sinks.refresh_table(t.queue.withColumn("priority_tier", F.lit("OLD")), path)
    sinks.refresh_table(t.queue, path)
    return t.spark.read.parquet(path).groupBy("priority_tier").agg(F.count(F.lit(1)).alias("rows"))


register("a09_full_refresh", _refreshed, "SELECT priority_tier, count(*) AS rows FROM queue GROUP BY ALL")


def _upserted(t: Tables) -> DataFrame:
    """Two upserts: every run first, then new values for the later run's test rows and rows of a third run."""
    root = _scratch(t)
    base = t.predictions
    sinks.upsert_predictions(t.spark, base, root)
    changed = base.filter("mlflow_run_id = 'run-b' AND split_name = 'test'").withColumns({
        "churn_probability": F.lit(0.5), "churn_risk_band": F.lit("VERY_HIGH"), "predicted_churn_label": F.lit(1), "model_version": F.lit("2"),
        "scored_at": F.lit("2001-08-01").cast("timestamp"),
    })
    added = base.filter("mlflow_run_id = 'run-a' AND split_name = 'backtest'").withColumn("mlflow_run_id", F.lit("run-c"))
    sinks.upsert_predictions(t.spark, changed.unionByName(added), root)
    return sinks.read_predictions(t.spark, root).select(
        "observation_date", "customer_id", "split_name", "mlflow_run_id", "churn_probability", "predicted_churn_label", "churn_risk_band", "model_version", "scored_at",
    )


register("a10_upsert_predictions", _upserted, f"""
SELECT {_KEY_SQL}, split_name, mlflow_run_id, CASE WHEN hit THEN 0.5e0 ELSE churn_probability END AS churn_probability,
  CASE WHEN hit THEN 1 ELSE predicted_churn_label END AS predicted_churn_label, CASE WHEN hit THEN 'VERY_HIGH' ELSE churn_risk_band END AS churn_risk_band,
  model_version, CASE WHEN hit THEN '2001-08-01 00:00:00' ELSE strftime(scored_at, '%Y-%m-%d %H:%M:%S') END AS scored_at
FROM (SELECT *, mlflow_run_id = 'run-b' AND split_name = 'test' AS hit FROM pred
  UNION ALL SELECT * REPLACE ('run-c' AS mlflow_run_id), false FROM pred WHERE mlflow_run_id = 'run-a' AND split_name = 'backtest')""")


def _latest_stored(t: Tables) -> DataFrame:
    """Two runs stored one after the other, then the rows of the latest: only its partitions are read."""
    root = _scratch(t)
    for run in ("run-a", "run-b"):
        sinks.upsert_predictions(t.spark, t.predictions.filter(F.col("mlflow_run_id") == run), root)
    return marts.of_latest_run(sinks.read_predictions(t.spark, root)).select(
        "observation_date", "customer_id", "split_name", "mlflow_run_id", "churn_probability", "predicted_churn_label", "churn_risk_band", "scored_at",
    )


register("c02_latest_run_stored", _latest_stored, f"""
SELECT {_KEY_SQL}, split_name, mlflow_run_id, churn_probability, predicted_churn_label, churn_risk_band,
  strftime(scored_at, '%Y-%m-%d %H:%M:%S') AS scored_at
FROM pred WHERE mlflow_run_id = (SELECT arg_max(mlflow_run_id, scored_at) FROM pred)""")


def _json_report(t: Tables) -> DataFrame:
    path = _scratch(t)
    weights = {"price_sensitivity_score": 1.35, "loyalty_score": -1.25}
    means = explain.feature_means(t.engineered, list(weights))
    summary = explain.summarize(explain.linear_contributions(t.engineered, weights, means, ["customer_id"]), list(weights))
    sinks.write_json_report(explain.explanation_report(summary, None, "rule_score", None, "linear contributions", 20), path)
    saved = t.spark.read.json(path)
    return saved.select("schema_version", "model_name", F.explode("top_features").alias("f")).select("schema_version", "model_name", "f.rank", "f.feature")


register("a11_json_report", _json_report, """
WITH w AS (SELECT 'price_sensitivity_score' AS feature, avg(abs(1.35e0 * (price_sensitivity_score - m1))) AS a FROM eng, (SELECT avg(price_sensitivity_score) AS m1 FROM eng)
  UNION ALL SELECT 'loyalty_score', avg(abs(1.25e0 * (loyalty_score - m2))) FROM eng, (SELECT avg(loyalty_score) AS m2 FROM eng))
SELECT '1.0' AS schema_version, 'rule_score' AS model_name, row_number() OVER (ORDER BY a DESC) AS rank, feature FROM w""")
register("a12_json_records", lambda t: sinks.json_records(t.labels.select(
    "customer_id", "observation_date", "churn_label", "churn_date", F.col("churn_probability").cast("decimal(6,4)").alias("churn_probability")
)).select(F.get_json_object("record", "$.customer_id").alias("customer_id"), F.get_json_object("record", "$.observation_date").alias("observation_date"),
          F.get_json_object("record", "$.churn_probability").cast("double").alias("churn_probability"), F.col("record").contains('"churn_date":null').alias("keeps_null")), f"""
SELECT customer_id, CAST(observation_date AS VARCHAR) AS observation_date, churn_probability, churn_date IS NULL AS keeps_null FROM lab""")


def _calendar(t: Tables) -> DataFrame:
    """The calendar over the ordered period, joined with the orders of each day."""
    days = tables.calendar(t.spark, dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    orders = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("calendar_date")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(orders, "calendar_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


register("a13_calendar", _calendar, """
WITH days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS calendar_date, year(d) AS calendar_year, quarter(d) AS calendar_quarter,
  month(d) AS calendar_month, monthname(d) AS month_name, day(d) AS day_of_month, isodow(d) AS day_of_week, weekofyear(d) AS week_of_year,
  isodow(d) >= 6 AS is_weekend, d = last_day(d) AS is_month_end, d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end,
  month(d) = 12 AND day(d) = 31 AS is_year_end, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = d) AS orders FROM days""")


def _governed(t: Tables) -> DataFrame:
    t.labels.createOrReplaceTempView("holdfast_labels")
    return governed_sql.query(
        t.spark, "SELECT split_name, churn_risk_band, count(*) AS rows FROM holdfast_labels WHERE churn_probability >= :floor GROUP BY ALL", {"floor": 0.1}, limit=200
    ).dataframe


register("a14_governed_sql", _governed, "SELECT split_name, churn_risk_band, count(*) AS rows FROM lab WHERE churn_probability >= 0.1e0 GROUP BY ALL")


def _audited(t: Tables) -> DataFrame:
    path = _scratch(t)
    n = t.dim_customer.count()
    row = sinks.audit_row(t.spark, "batch-1", "reset", {
        "seed": 42, "n_customers": n, "history_start_date": dt.date(1995, 1, 1), "history_end_date": dt.date(2001, 6, 30),
    })
    sinks.append_audit(row, path)
    sinks.append_audit(row.withColumn("batch_id", F.lit("batch-2")), path)
    return t.spark.read.parquet(path).select("batch_id", "generation_mode", "seed", "n_customers", "history_end_date", "status", "error_message")


register("a16_audit_rows", _audited, """
SELECT b AS batch_id, 'reset' AS generation_mode, 42 AS seed, (SELECT count(*) FROM customer) AS n_customers, '2001-06-30' AS history_end_date,
  'SUCCEEDED' AS status, CAST(NULL AS VARCHAR) AS error_message FROM (VALUES ('batch-1'), ('batch-2')) v(b)""")
