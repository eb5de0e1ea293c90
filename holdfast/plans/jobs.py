"""The batch jobs. Tables live as Parquet folders below one root; CSV copies go beside the reports.

Each job reads only stored tables of the jobs before it, so any of them can be rerun after a failure.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import (
    drift, explain, features, leakage, marts, metrics, model, preprocess, priority, quality, recommend, selection, snapshot,
)
from holdfast.schemas import TABLE_NAMES, TABLE_RULES
from holdfast.session import materialize
from holdfast.sources import reports, sinks, tables

PARTITIONED = {"customer_360_snapshot", "churn_label"}


@dataclass(frozen=True)
class Store:
    """Where tables and reports live."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> None:
        sinks.refresh_table(df, self.path(name), ["split_name"] if name in PARTITIONED else [])

    def predictions(self) -> DataFrame:
        return sinks.read_predictions(self.spark, self.path("churn_prediction"))


def load_csv(store: Store, folder: str, seed: int = 42, names: Sequence[str] = TABLE_NAMES) -> dict[str, DataFrame]:
    """Declared CSV files to tables, plus an audit row. Tables load independently of each other."""
    started = dt.datetime.now(dt.UTC)
    loaded = tables.read_csv_folder(store.spark, folder, names)
    for name, df in loaded.items():
        store.write(name, df)
    stored = {name: store.read(name) for name in loaded}
    customers = stored["dim_customer"].count() if "dim_customer" in stored else 0
    sinks.append_audit(sinks.audit_row(
        store.spark, f"BATCH_{uuid.uuid4().hex[:12]}", "reset",
        {"seed": seed, "n_customers": customers, "history_start_date": None, "history_end_date": None}, started=started,
    ), store.path("generation_batch_log"))
    return stored


def check_integrity(store: Store, names: Sequence[str]) -> DataFrame:
    """Violated rules of the stored tables, written as a report."""
    report = quality.integrity_report({n: store.read(n) for n in names}, TABLE_RULES).filter("violations > 0")
    sinks.write_csv(report, store.path("reports/integrity"))
    return report


def build_snapshots(
    store: Store, dates: snapshot.Dates = snapshot.SNAPSHOT_DATES
) -> tuple[DataFrame, DataFrame]:
    """Snapshot and label tables from the stored facts in one pass."""
    facts = {
        "policies": "fact_policy", "products": "dim_product", "payments": "fact_payment", "claims": "fact_claim",
        "interactions": "fact_interaction", "cases": "fact_customer_service", "campaigns": "fact_campaign_contact",
        "quotes": "fact_quote", "actions": "fact_retention_action",
    }
    wide = materialize(snapshot.build_snapshot(
        store.read("dim_customer"), dates, **{k: store.read(t) for k, t in facts.items()}
    ), "wide_snapshot")
    labels = snapshot.label_table(wide)
    store.write("customer_360_snapshot", snapshot.snapshot_table(wide))
    store.write("churn_label", labels)
    return store.read("customer_360_snapshot"), store.read("churn_label")


def training_panel(store: Store) -> DataFrame:
    return marts.training_mart(
        store.read("customer_360_snapshot"), store.read("churn_label"), store.read("dim_customer"), store.read("dim_agency"),
        store.read("dim_geography"),
    )


def run_drift(store: Store) -> DataFrame:
    """The drift report as CSV and its summary as JSON."""
    report = materialize(drift.analyze(features.engineer(training_panel(store))), "drift_report")
    sinks.write_csv(report, store.path("reports/churn_drift_report"))
    top = drift.top_drift(report, 15).agg(F.collect_list(F.struct("*"))).scalar()
    sinks.write_json_report(drift.summary_counts(report).withColumn("top_drift_features", top), store.path("reports/churn_drift_summary"))
    return report


@dataclass(frozen=True)
class TrainingResult:
    run_id: str
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame


def run_training(store: Store, config: model.TrainingConfig = model.TrainingConfig(), allow_leakage: bool = False) -> TrainingResult:
    """Select stable features, audit, fit, evaluate, explain and upsert the predictions."""
    raw = training_panel(store)
    report = reports.read_drift_report(store.spark, store.path("reports/churn_drift_report"))
    summary = selection.selection_summary(selection.select_features(report, selection.feature_contract(store.spark, raw.columns)))
    sinks.write_json_report(summary, store.path("reports/drift_feature_exclusions"))
    chosen = summary.first()
    excluded = chosen.excluded_engineered_features
    panel = materialize(features.engineer(selection.drop_raw_columns(raw, chosen.raw_columns_to_drop), excluded), "training_panel")
    numeric, categorical = chosen.selected_numeric_features, chosen.selected_categorical_features
    findings = materialize(leakage.audit(panel, [*numeric, *categorical]), "leakage_findings")
    sinks.write_csv(findings.withColumn("details", F.to_json("details")), store.path("reports/leakage_audit"))
    sinks.write_csv(preprocess.class_distribution(panel), store.path("reports/class_distribution"))
    if not allow_leakage:
        leakage.assert_no_critical(findings)
    preprocess.validate_split_order(panel)
    fills = preprocess.FillValues(numeric, categorical).fit(panel.filter("split_name = 'train'"))
    prepared = materialize(fills.transform(panel), "prepared_panel")
    boosted = model.boost(prepared, numeric, categorical, config)
    fitted = boosted.model
    curve = materialize(model.training_curve(boosted, {
        "learn": prepared.filter("split_name = 'train'"), "validation": prepared.filter("split_name = 'validation'"),
    }), "training_curve")
    sinks.write_csv(curve.orderBy("dataset", "metric", "iteration"), store.path("reports/training_curve"))
    sinks.write_json_report(model.training_diagnostics(curve), store.path("reports/training_diagnostics"))
    fitted.write().overwrite().save(store.path("models/churn"))
    store.write("prepared_panel", prepared)
    scores = materialize(model.score(fitted, prepared.filter("split_name <> 'train'")), "scores")
    run_id = uuid.uuid4().hex
    evaluated = metrics.evaluate(scores, config.threshold)
    sinks.write_csv(metrics.confusion_cells(scores, config.threshold), store.path("reports/confusion_matrix_by_split"))
    sinks.write_csv(metrics.threshold_grid(scores.filter("split_name = 'test'")), store.path("reports/threshold_tradeoff_grid"))
    linear = model.logistic_pipeline(numeric, categorical).fit(prepared.filter("split_name = 'train'"))
    weights, levels = model.linear_weights(linear, numeric), model.level_weights(linear, numeric, categorical)
    train = prepared.filter("split_name = 'train'")
    means = explain.feature_means(train, numeric, levels)
    contributions = explain.linear_contributions(train, weights, means, ["customer_id"], levels)
    importance = materialize(explain.summarize(contributions, [*numeric, *categorical]), "importance")
    sinks.write_csv(importance, store.path("reports/shap_summary"))
    sinks.write_json_report(
        explain.explanation_report(importance, evaluated, config.model_name, run_id, "exact linear contributions of the logistic surrogate", 20),
        store.path("reports/shap_agent_report"),
    )
    rows = model.prediction_rows(scores, config.threshold, config.model_name, run_id)
    sinks.upsert_predictions(store.spark, rows, store.path("churn_prediction"))
    return TrainingResult(run_id, store.predictions(), evaluated, importance)


def rescore(store: Store, threshold: float, model_name: str) -> DataFrame:
    """Score the stored panel with the saved model and upsert the predictions under a new run."""
    fitted = PipelineModel.load(store.path("models/churn"))
    scores = model.score(fitted, store.read("prepared_panel").filter("split_name <> 'train'"))
    sinks.upsert_predictions(store.spark, model.prediction_rows(scores, threshold, model_name, uuid.uuid4().hex), store.path("churn_prediction"))
    return store.predictions()


def run_queue(store: Store, splits: Sequence[str] = ("test", "backtest"), top_n: int | None = None) -> DataFrame:
    """The retention queue of the latest prediction run."""
    candidates = marts.candidate_mart(
        store.predictions(), store.read("customer_360_snapshot"), store.read("dim_customer"), store.read("dim_channel"),
        store.read("dim_agency"), store.read("dim_geography"), splits,
    )
    queue = priority.ordered_queue(priority.score(materialize(candidates, "candidates")), top_n)
    store.write("retention_priority_queue", quality.with_defaults(queue, stamps=["queued_at"]))
    stored = store.read("retention_priority_queue")
    sinks.write_csv(stored.drop("queued_at"), store.path("reports/retention_priority_queue"))
    return stored


def run_recommendations(store: Store, limit: int | None = None) -> DataFrame:
    """Recommendations for every queue row of the review tiers, or for the first ``limit``."""
    chosen = recommend.queue_for_review(store.read("retention_priority_queue"), limit)
    store.write("retention_recommendation", quality.with_defaults(recommend.recommend(chosen), stamps=["created_at"]))
    stored = store.read("retention_recommendation")
    sinks.write_csv(stored.drop("created_at"), store.path("reports/retention_recommendation"))
    return stored

