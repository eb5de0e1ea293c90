"""Physical plan assertions and the jobs end to end."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from holdfast.operators import metrics, model, snapshot
from holdfast.plans import jobs
from holdfast.sources.sample_tables import SAMPLE_DATES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_is_one_shuffle_without_joins_between_facts(tables):
    plan = plan_of(snapshot.build_snapshot(tables.dim_customer, SAMPLE_DATES, **tables.facts()))
    assert plan.count("Exchange hashpartitioning(customer_id#") == 2  # that of all facts and the narrow one of contacts
    others = {k: v for k, v in tables.facts().items() if k != "interactions"}
    assert plan_of(snapshot.build_snapshot(tables.dim_customer, SAMPLE_DATES, **others)).count("Exchange hashpartitioning(customer_id") == 1
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_contacts_are_carried_and_not_copied(spark):
    """Rows of every operator of the executed plan: none holds more than the contacts, yet early contacts reach late dates."""
    dates = [(dt.date(2020 + i, 12, 31), "train") for i in (2, 0, 3, 1)] + [(dt.date(2023, 11, 30), "train")]  # unsorted, one window overlaps
    contacts = spark.range(0, 10_000, 1, 4).selectExpr(
        "concat('C', id % 50) AS customer_id", "IF(id % 3 = 0, 'CH_WEB', 'CH_AGENT') AS channel_id",
        "timestampadd(HOUR, int(id * 7 % 40000), TIMESTAMP'2020-01-01') AS interaction_datetime",
    )
    contacts = contacts.unionByName(spark.createDataFrame([("C9", "CH_WEB", None), (None, "CH_WEB", dt.datetime(2020, 5, 1))], contacts.schema))
    contacts.collect()
    got = snapshot.interaction_measures(contacts, dates)
    rows = {(r.customer_id, r.observation_date): (r.i_last_day, r.i_3m, r.i_digital_30d) for r in got.collect()}
    plan, made = got._jdf.queryExecution().executedPlan().finalPhysicalPlan(), []

    def walk(node):
        node = node.plan() if "QueryStage" in node.nodeName() else node
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            made.append(metric.get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    assert made and max(made) <= 10_002
    every = snapshot.expand_to_dates(contacts.withColumn("d", F.to_date("interaction_datetime")), "d", dates)
    assert every.count() > 20_000
    expected = every.groupBy("customer_id", "observation_date").agg(
        F.max("d"), F.expr("sum(CASE WHEN d >= date_sub(observation_date, 92) THEN 1 END)"),
        F.expr("sum(CASE WHEN channel_id = 'CH_WEB' AND d >= date_sub(observation_date, 30) THEN 1 END)"),
    )
    assert rows == {(r[0], r[1]): tuple(r[2:]) for r in expected.collect()}


@pytest.mark.parametrize("build", [
    lambda t: t.fresh_wide(), lambda t: metrics.evaluate(t.scores, 0.14), lambda t: t.mart, lambda t: t.candidates,
])
def test_no_python_workers_and_no_cross_joins(tables, build):
    plan = plan_of(build(tables))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_scan_reads_only_needed_columns(tables):
    plan = plan_of(tables.wide_of("payments").select("customer_id", "late_payment_count_12m"))
    assert "l_tax" not in plan and "l_comment" not in plan


def test_jobs_end_to_end(spark, tables, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    for name in (
        "dim_customer", "dim_agency", "dim_geography", "dim_channel", "dim_product", "fact_policy", "fact_payment", "fact_claim", "fact_interaction",
        "fact_customer_service", "fact_campaign_contact", "fact_quote", "fact_retention_action",
    ):
        store.write(name, getattr(tables, name))
    snapshots, labels = jobs.build_snapshots(store, SAMPLE_DATES)
    assert snapshots.count() == labels.count() == tables.dim_customer.count() * len(SAMPLE_DATES)
    assert jobs.check_integrity(store, ["dim_customer", "fact_policy", "churn_label"]).count() == 0
    assert jobs.run_drift(store).count() > 0
    result = jobs.run_training(store, model.TrainingConfig(iterations=3, min_rows_per_leaf=5))
    assert {r.split_name for r in result.metrics.collect()} == {"validation", "test", "backtest"}
    again = jobs.rescore(store, 0.14, "churn_gbt")
    assert again.select("mlflow_run_id").distinct().count() == 2
    runs = again.groupBy("customer_id", "observation_date").agg(F.count_distinct("churn_probability").alias("n"))
    assert runs.agg(F.max("n")).first()[0] == 1
    queue = jobs.run_queue(store)
    assert queue.count() == 2 * tables.dim_customer.count()
    assert jobs.run_recommendations(store, 20).count() <= 20
