"""Golden values, edge cases and independent checks of the operators."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.functions import dates, numeric, text
from holdfast.operators import (
    drift, explain, features, leakage, lifecycle, marts, metrics, prefix, preprocess, priority, quality, recommend, retrieval, selection, signals, snapshot,
)
from holdfast.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, table_schema
from holdfast.session import parts_for

SPLITS = (("train", dt.date(2023, 12, 31), 0), ("validation", dt.date(2024, 12, 31), 1), ("test", dt.date(2025, 12, 31), 0), ("backtest", dt.date(2026, 6, 30), 1))


@pytest.fixture(scope="module")
def panel(spark):
    """Four rows, one per split; every categorical feature is null."""
    rows = [
        (day, f"CUST-{s}", s, label, dt.date(1985, 1, 1), dt.date(2020, 1, 1), day + dt.timedelta(30) if label else None,
         "CHURNED_WITHIN_HORIZON" if label else "ACTIVE_OBSERVED") for s, day, label in SPLITS
    ]
    base = spark.createDataFrame(rows, (
        "observation_date DATE, customer_id STRING, split_name STRING, churn_label INT, birth_date DATE, acquisition_date DATE, "
        "churn_date DATE, customer_lifecycle_status STRING"
    ))
    return base.select("*", *[F.lit(1.0).alias(c) for c in NUMERIC_FEATURES], *[F.lit(None).cast("string").alias(c) for c in CATEGORICAL_FEATURES])


def scored(spark, labels, values, split="test"):
    return spark.createDataFrame([(split, y, float(p)) for y, p in zip(labels, values, strict=True)], "split_name STRING, label INT, score DOUBLE")


# --- functions -----------------------------------------------------------------------------------

def test_even_round_equals_numpy(spark):
    values = [0.125, 0.135, 2.675, 1.005, 0.575, -0.125, 1e6 + 0.005, 0.0]
    got = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select(numeric.even_round("v", 2).alias("r")).collect()
    assert [r.r for r in got] == list(np.round(values, 2))


def test_clip_keeps_null_and_number_drops_nan(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS a, 'x' AS b, DOUBLE('NaN') AS c, 7D AS d").select(
        numeric.clip("a", 0.0, 1.0), numeric.number("b"), numeric.number("c"), numeric.clip("d", 0.0, 1.0), numeric.ratio_or_zero("d", F.lit(0)),
    ).first()
    assert tuple(row) == (None, None, None, 1.0, 0.0)


def test_dates(spark):
    row = spark.sql("SELECT DATE'2024-02-29' AS d, DATE'2025-01-01' AS e").select(
        dates.add_years("d", 1), dates.calendar_months("e", "d"), dates.calendar_months("d", "e"), dates.date_key("d"), dates.week_start("e")
    ).first()
    assert tuple(row) == (dt.date(2025, 2, 28), 11, 0, 20240229, dt.date(2024, 12, 30))


def test_text_functions(spark):
    row = spark.createDataFrame([("Élève ŒUVRE ﬁn été ½", "un_nom")], "t STRING, s STRING").select(
        text.normalise("t").alias("n"), text.words(text.normalise("t"), ("un",)).alias("w"), text.heading("t", "s").alias("h"),
        text.with_bigrams(F.array(F.lit("aa"), F.lit("bb"), F.lit("aa"))).alias("b"), text.with_bigrams(F.array().cast("array<string>")).alias("none"),
    ).first()
    assert row.n == "eleve œuvre fin ete 1⁄2"
    assert row.w == ["eleve", "œuvre", "fin", "ete"]
    assert row.h == "Un Nom"
    assert row.b == ["aa", "bb", "aa", "aa bb", "bb aa"] and row.none == []


# --- prefix sums ---------------------------------------------------------------------------------

def test_prefix_sums_and_rank_against_pandas(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([np.zeros(900), rng.integers(0, 400, 2000) / 4, rng.normal(50, 30, 500).round(3)])
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id LONG, v DOUBLE")
    ranked = prefix.average_percent_rank(rows, "v", "r", ["id"]).toPandas().sort_values("id")
    assert len(ranked) == len(values)
    assert np.allclose(ranked.r, ranked.v.rank(pct=True))
    counts = rows.withColumn("k", F.col("id") % 2).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = prefix.exact_quantiles(prefix.prefix_sums(counts, "v", ["n"], ["k"]), "v", "n", [0, 0.1, 0.5, 0.93, 1], ["k"]).toPandas()
    for k in (0, 1):
        expected = np.quantile(values[k::2], [0, 0.1, 0.5, 0.93, 1])
        assert np.allclose(got[got.k == k].sort_values("quantile_index")["quantile"], expected)


def test_spread_lookup_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 != 0, F.lit(1)).otherwise(F.col("id")).alias("key"))
    table = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("value", F.col("key") * 10)
    got = prefix.spread_lookup(rows, table, "key", "n", ["value"], ["id"])
    assert got.count() == 5000 and got.filter("value <> key * 10 OR value IS NULL").count() == 0


# --- preprocessing, splits, leakage --------------------------------------------------------------

def test_fill_values(panel):
    with pytest.raises(RuntimeError):
        preprocess.FillValues().transform(panel)
    fills = preprocess.FillValues().fit(panel.filter("split_name = 'train'"))
    out = fills.transform(panel)
    assert quality.missing_counts(out.select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES), only_missing=True).count() == 0
    assert {r[0] for r in out.select("region").collect()} == {"UNKNOWN"}
    with pytest.raises(KeyError):
        preprocess.FillValues().fit(panel.drop("region"))


def test_medians_and_modes_with_ties_and_nulls(spark):
    rows = spark.createDataFrame([(1.0, "b"), (4.0, "a"), (None, "a"), (2.0, "b"), (9.0, None)], "x DOUBLE, c STRING")
    both = rows.withColumn("empty", F.lit(None).cast("double"))
    assert {r.feature: r.fill_value for r in preprocess.numeric_medians(both, ["x", "empty"]).collect()} == {"x": 3.0, "empty": 0.0}
    assert preprocess.categorical_modes(rows, ["c"]).first().fill_value == "a"


def test_split_order(panel):
    assert set(preprocess.temporal_split(panel)) == {"train", "validation", "test", "backtest"}
    overlapping = panel.withColumn("observation_date", F.lit(dt.date(2024, 1, 1)))
    with pytest.raises(ValueError, match="Temporal leakage risk"):
        preprocess.validate_split_order(overlapping)
    with pytest.raises(ValueError, match="Missing expected"):
        preprocess.validate_split_order(panel.filter("split_name <> 'test'"))


def test_class_distribution(panel):
    rows = preprocess.class_distribution(panel).collect()
    assert len(rows) == 4 and sum(r.share for r in rows) == 4.0


def test_leakage_audit(panel):
    stable = [c for c in NUMERIC_FEATURES + CATEGORICAL_FEATURES if c != "latent_churn_risk_band"]
    report = {r.check_name: r.status for r in leakage.assert_no_critical(leakage.audit(panel, stable)).collect()}
    assert report["forbidden_features_not_in_model_contract"] == "passed"
    with pytest.raises(ValueError, match="Critical data leakage"):
        leakage.assert_no_critical(leakage.audit(panel, [*stable, "churn_label"]))
    assert leakage.churn_date_finding(panel.drop("churn_date")).first().status == "skipped"


# --- drift and selection -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def drifting(spark):
    rows = [("train", 10 + i, "A" if i % 2 else "B", i % 2) for i in range(6)] + [("test", 80 + 2 * i, "A" if i % 2 else "C", i % 2) for i in range(6)]
    return spark.createDataFrame(rows, "split_name STRING, tenure_months INT, customer_segment STRING, churn_label INT")


def test_drift_report(drifting):
    report = drift.analyze(drifting, ["tenure_months"], ["customer_segment"]).collect()
    assert {r.feature for r in report} == {"tenure_months", "customer_segment", "churn_label"}
    assert all((r.reference_split, r.comparison_split) == ("train", "test") for r in report)
    tenure = next(r for r in report if r.feature == "tenure_months")
    assert tenure.severity == "high" and tenure.secondary_metric == 1.0
    segment = next(r for r in report if r.feature == "customer_segment")
    p, q = np.array([0.5, 0.5, 0.0]), np.array([0.5, 0.0, 0.5])
    a, b = np.clip(p, 1e-6, None), np.clip(q, 1e-6, None)
    assert segment.psi == pytest.approx(float(np.sum((b - a) * np.log(b / a))))
    assert segment.secondary_metric == pytest.approx(np.sqrt(0.5 * np.log(2)))
    assert next(r for r in report if r.feature == "churn_label").psi == pytest.approx(0.0, abs=1e-12)


def test_drift_all_null_feature_is_stable(drifting):
    report = drift.analyze(drifting.withColumn("tenure_months", F.lit(None).cast("double")), ["tenure_months"], [], None).first()
    assert (report.psi, report.secondary_metric, report.secondary_pvalue, report.severity) == (0.0, 0.0, 1.0, "stable")


def test_selection(spark, drifting):
    report = drift.analyze(drifting, ["tenure_months"], ["customer_segment"])
    contract = selection.feature_contract(spark, ["tenure_months", "customer_segment", "renewal_days_min", "birth_date"])
    chosen = selection.selection_summary(selection.select_features(report, contract)).first()
    assert "tenure_months" in chosen.raw_columns_to_drop and "tenure_months" not in chosen.selected_numeric_features
    assert "latent_churn_risk_band" in chosen.features_to_remove


# --- metrics -------------------------------------------------------------------------------------

def test_perfect_scores(spark):
    row = metrics.evaluate(scored(spark, [0, 1, 1, 0], [0.1, 0.8, 0.7, 0.2]), 0.5).first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.auc, row.average_precision) == (1, 1, 1, 1, 1, 1)


def test_confusion_and_grid(spark):
    cells = metrics.confusion_cells(scored(spark, [0, 0, 1, 1], [0.1, 0.7, 0.4, 0.9]), 0.5).collect()
    assert [r.rows for r in cells] == [1, 1, 1, 1]
    grid = metrics.threshold_grid(scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.7, 0.9]), [0.2, 0.5, 0.8])
    assert grid.filter("threshold = 0.5").first().churn_detected == 2
    assert metrics.best_threshold(grid).first().threshold == 0.5
    assert metrics.DEFAULT_CUTS == (0.02, 0.06, 0.1, 0.14, 0.18, 0.22, 0.26, 0.3, 0.34, 0.38)


def test_ranking_metrics_with_ties_and_one_class(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 600), (rng.random(600) * 12).round() / 12
    row = metrics.ranking_metrics(scored(spark, y.tolist(), p.tolist())).first()
    pairs = (p[y == 1][:, None] > p[y == 0][None, :]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).mean()
    assert row.auc == pytest.approx(pairs)
    expected, seen = 0.0, 0.0
    for cut in np.unique(p)[::-1]:
        hit = p >= cut
        recall = y[hit].sum() / y.sum()
        expected += (recall - seen) * y[hit].mean()
        seen = recall
    assert row.average_precision == pytest.approx(expected)
    assert metrics.ranking_metrics(scored(spark, [0, 0], [0.1, 0.2])).first().auc == 0.0


# --- retention -----------------------------------------------------------------------------------

def candidate(customer, p, premium, loyalty, increase, complaints):
    return {
        "observation_date": dt.date(2026, 6, 30), "customer_id": customer, "split_name": "backtest", "first_name": "A", "last_name": "B",
        "customer_segment": "HIGH_VALUE", "region": "Bretagne", "agency_name": "Agency", "main_product_family": "AUTO",
        "churn_probability": p, "churn_risk_band": "HIGH", "model_name": "m", "model_version": None, "mlflow_run_id": "run-1",
        "scored_at": dt.datetime(2026, 7, 1), "price_sensitivity_score": 0.4, "loyalty_score": loyalty, "total_annual_premium": premium,
        "customer_value_score": 0.2, "active_policy_count": 2, "retention_acceptance_rate_12m": 0.5, "campaign_response_rate_6m": 0.2,
        "service_case_count_12m": 1, "unresolved_case_count_12m": 0, "renewal_days_min": 20, "highest_coverage_tier": "PREMIUM",
        "premium_increase_pct_max_12m": increase, "competitor_price_index_avg_6m": 1.0, "complaints_6m": complaints, "payment_incidents_6m": 0,
        "rejected_payment_count_12m": 0, "digital_sessions_30d": 3, "email_open_rate_6m": 0.3, "preferred_channel_code": "WEB",
        "consent_phone": True, "consent_email": True, "consent_sms": False,
    }


@pytest.fixture(scope="module")
def candidates(spark):
    schema = ", ".join(
        f"{k} {'STRING' if v is None or isinstance(v, str) else 'BOOLEAN' if isinstance(v, bool) else 'INT' if isinstance(v, int) else 'DOUBLE' if isinstance(v, float) else 'TIMESTAMP' if isinstance(v, dt.datetime) else 'DATE'}"
        for k, v in candidate("x", 0.1, 1.0, 0.1, 0.1, 1).items()
    )
    rows = [candidate("CUST-LOW", 0.25, 300.0, 0.3, 0.02, 0), candidate("CUST-HIGH", 0.55, 2400.0, 0.9, 0.15, 2)]
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def test_queue_order_and_rules(candidates):
    first = priority.ordered_queue(priority.score(candidates)).first()
    assert first.customer_id == "CUST-HIGH" and first.priority_tier in ("HIGH", "CRITICAL")
    assert first.recommended_action_type == "LOYALTY_DISCOUNT_REVIEW" and first.recommended_channel == "PHONE"
    assert "recent premium increase" in first.action_reason
    assert priority.score(candidates, match_codes=True).filter("recommended_channel = 'EMAIL'").count() == 2


def test_empty_queue_is_typed(candidates):
    empty = priority.score(candidates.filter("false"))
    assert empty.count() == 0 and set(priority.QUEUE_COLUMNS) == set(empty.columns)
    assert recommend.recommend(empty).count() == 0


def test_recommendation_text(spark):
    row = spark.createDataFrame([(
        dt.date(2026, 6, 30), "CUST-1", "backtest", "Ada", "Li", "HIGH", 58.2, 0.42, 280.0, "LOYALTY_DISCOUNT_REVIEW", "PHONE", "why", 120.0, "run-1",
    )], (
        "observation_date DATE, customer_id STRING, split_name STRING, first_name STRING, last_name STRING, priority_tier STRING, priority_score DOUBLE, "
        "churn_probability DOUBLE, expected_saved_value DOUBLE, recommended_action_type STRING, recommended_channel STRING, action_reason STRING, "
        "estimated_offer_value DOUBLE, mlflow_run_id STRING"
    ))
    got = recommend.recommend(row).first()
    assert got.recommended_offer == "Controlled loyalty discount - max budget 120.00 EUR"
    assert got.recommendation_id == "REC_85910DF759F50E8B"
    assert (got.human_review_status, got.approval_decision) == ("PENDING_REVIEW", None)
    assert "Churn probability 42.0%" in got.decision_rationale
    unknown = recommend.recommend(row.withColumn("recommended_action_type", F.lit("OTHER"))).first()
    assert unknown.recommended_offer.startswith("Proactive retention check")
    draft = recommend.contact_drafts(row.select("customer_id", "first_name")).first()
    assert draft.channel == "EMAIL" and "a personalized advisor check-in" in draft.body


def test_signals(spark):
    row = spark.createDataFrame([("C", 0.9, 3.0, 10, 20, 1, 0, "because", 0.3, "HIGH")], (
        "customer_id STRING, price_sensitivity_score DOUBLE, avg_satisfaction_score_12m DOUBLE, renewal_days_min INT, days_since_last_contact INT, "
        "payment_incidents_6m INT, complaints_6m INT, action_reason STRING, churn_probability DOUBLE, churn_risk_band STRING"
    ))
    found = signals.customer_signals(row).collect()
    assert [s.field for s in found][:2] == ["renewal_days_min", "payment_incidents_6m"]
    assert [s.severity for s in found] == sorted((s.severity for s in found), reverse=True)
    assert {s.field for s in found} == {"payment_incidents_6m", "renewal_days_min", "action_reason", "price_sensitivity_score", "avg_satisfaction_score_12m"}
    assert next(s.value for s in found if s.field == "renewal_days_min") == "10 jours"
    view = signals.probability_view(row).first()
    assert view.derived_risk_band == "MEDIUM" and "verifier la calibration" in view.consistency_note


def test_importance_summary(spark):
    wide = spark.createDataFrame([(1.0, -2.0), (3.0, -2.0)], "a DOUBLE, b DOUBLE")
    rows = explain.summarize(wide, ["a", "b"]).collect()
    assert [(r.rank, r.feature, r.impact_direction) for r in rows] == [(1, "a", "increases_churn_risk"), (2, "b", "decreases_churn_risk")]
    assert sum(r.normalized_importance_pct for r in rows) == pytest.approx(100.0)
    assert explain.driver_lines(explain.summarize(wide, ["a", "b"]), 1).first().driver == "a: increases_churn_risk (50.0%)"


def test_importance_ties_do_not_hang_on_summation_order(spark):
    """Averages of the same hundredths that differ in the last bit only rank by name."""
    rows = spark.createDataFrame([("b", 0.49500000000000005, 1.0), ("a", 0.495, 1.0), ("c", 57.0, 1.0), ("d", 0.49501, 1.0)], "feature STRING, mean_abs_shap DOUBLE, mean_shap DOUBLE")
    rows = rows.withColumns({"feature_type": F.lit("numeric"), "positive_impact_share": F.lit(0.5)})
    ranked = explain.rank_importance(rows)
    assert [(r["rank"], r.feature) for r in ranked.collect()] == [(1, "c"), (2, "d"), (3, "a"), (4, "b")]
    assert "_tie" not in ranked.columns


def test_contributions_sum_to_the_margin(spark):
    """Contributions plus the mean margin give each row's linear score."""
    rows = spark.createDataFrame([("a", 1.0, "x"), ("b", 3.0, "y"), ("c", None, "z")], "id STRING, n DOUBLE, c STRING")
    weights, levels = {"n": 2.0}, {"c": {"x": 0.5, "y": -1.0}}
    means = explain.feature_means(rows, ["n"], levels)
    got = {r.id: r.n + r.c for r in explain.linear_contributions(rows, weights, means, ["id"], levels).collect()}
    base = 2.0 * means["n"] + means["c"]
    assert {k: pytest.approx(v + base) for k, v in got.items()} == {"a": 2.5, "b": 5.0, "c": 4.0}


# --- snapshot, quality, retrieval ----------------------------------------------------------------

def test_windows_are_inclusive_at_both_ends(spark):
    days = ((dt.date(2025, 12, 31), "test"),)
    fact = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2024, 12, 31),), (dt.date(2024, 12, 30),), (dt.date(2026, 1, 1),), (dt.date(2026, 3, 31),), (dt.date(2026, 4, 1),)], "d DATE")
    assert snapshot.expand_to_dates(fact, "d", days, 365).count() == 2
    assert snapshot.expand_to_dates(fact, "d", days, ahead_days=90).count() == 2


def test_snapshot_combines_wide_rows_only_where_customers_were_dealt(tables, monkeypatch):
    monkeypatch.setattr(snapshot, "ROWS_PER_TASK", 100)
    wide = tables.wide_of("payments", "interactions")
    assert wide.rdd.getNumPartitions() == -(-tables.dim_customer.count() * 6 // 100)  # no fewer, though they hold few bytes
    above, dealt, _ = wide._jdf.queryExecution().sparkPlan().toString().partition("REPARTITION_BY_NUM")
    assert dealt and above.count("HashAggregate") == 2 and "partial_sum(y_late" in above


@pytest.mark.parametrize(("rows", "parts"), [(0, 1), (100, 1), (101, 2), (20_000, 200), (20_001, 200), (200_000, 200), (300_001, 301)])
def test_parts_stay_few_enough_to_stream_until_they_hold_too_much(rows, parts):
    assert parts_for(rows, 100, 1000) == parts


def test_sampled_negatives_fill_the_gap(tables):
    chosen = lifecycle.sample_negatives(tables.labels, 0.3, 0.35)
    assert chosen.distinct().count() == chosen.count()
    assert chosen.join(tables.labels.filter("churn_label = 1"), ["observation_date", "customer_id"], "left_semi").count() == 0
    added = {r.split_name: r.n for r in chosen.groupBy("split_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in tables.labels.groupBy("split_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("churn_label").alias("pos")).collect():
        assert 0.3 <= (r.pos + added.get(r.split_name, 0)) / r.rows < 0.37


def test_folding_beyond_latin(spark):
    import unicodedata

    words = ["ガス", "हिन्दी", "กำลัง", "한국어", "Élevé", "ﬁn", "½", "Ǆ", "plain"]
    rows = spark.createDataFrame([(w,) for w in words], "w STRING")
    plain = lambda w: "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))
    assert {(r.w, r.f) for r in rows.select("w", text.fold_accents("w").alias("f")).collect()} == {(w, plain(w)) for w in words}


def test_top_k_with_a_constant_score(spark):
    rows = spark.range(50).selectExpr("IF(id < 50, 'test', 'none') AS split_name", "id AS customer_id", "CAST(id % 2 AS INT) AS label", "0.5D AS score")
    result = metrics.top_k_metrics(rows, (10,), ["customer_id"])
    assert "WindowGroupLimit" in result._jdf.queryExecution().executedPlan().toString()
    assert (result.first().hits, result.first().precision_at_k) == (5, 0.5)


def test_catalog_default(spark):
    catalog = spark.sql("SELECT * FROM VALUES ('a', 1), ('z', 9) AS t(k, v)")
    rows = spark.sql("SELECT * FROM VALUES ('a'), ('b') AS t(k)")
    assert {(r.k, r.v) for r in marts.with_default(rows, catalog, "k", "z").collect()} == {("a", 1), ("b", 9)}


def test_tfidf_against_numpy(spark):
    texts = ["prix hausse prix remise", "paiement rejet prelevement", "sinistre delai indemnisation le prix", ""]
    documents = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "document_id STRING, text STRING")
    queries = spark.createDataFrame([(1, "le prix hausse"), (2, "inconnu")], "query_id LONG, text STRING")
    index = retrieval.build_index(documents)
    vocabulary, rows = {}, []
    for t in texts:
        tokens = [w for w in t.split() if w not in retrieval.STOP_WORDS]
        terms = tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)]
        rows.append([vocabulary.setdefault(w, len(vocabulary)) for w in terms])
    tf = np.zeros((len(texts), len(vocabulary)))
    for i, r in enumerate(rows):
        for j in r:
            tf[i, j] += 1
    idf = np.log((1 + len(texts)) / (1 + (tf > 0).sum(0))) + 1
    weights = tf * idf
    norms = np.linalg.norm(weights, axis=1)
    query = np.zeros(len(vocabulary))
    for w in ("prix", "hausse", "prix hausse"):
        query[vocabulary[w]] = 1
    query = query * idf
    expected = {f"d{i}": float(weights[i] @ query / norms[i] / np.linalg.norm(query)) for i in range(3) if weights[i] @ query > 0}
    got = {r.document_id: r.score for r in retrieval.cosine_scores(queries, index).collect()}
    assert got == pytest.approx(expected)
    hits, info = retrieval.corrective_search(queries, index)
    status = {r.query_id: r.retrieval_status for r in info.collect()}
    assert status[1] == "relevant" and status[2] in ("corrected", "low_confidence", "no_match")
    assert hits.filter("query_id = 1").count() == len(expected)


def test_features_skip_missing_and_excluded(panel):
    raw = panel.drop("customer_age_years", "premium_per_policy", "renewal_window", "total_annual_premium")
    out = features.engineer(raw, ["renewal_window"])
    assert "customer_age_years" in out.columns and "premium_per_policy" not in out.columns and "renewal_window" not in out.columns
    assert out.filter("split_name = 'validation'").first().days_to_churn_after_observation == 30


def test_schema_registry():
    assert table_schema("churn_prediction")["churn_probability"].dataType.simpleString() == "decimal(8,6)"


def _random_corpus(spark, n: int = 400):
    dice = np.random.default_rng(6)
    words = [f"mot{i:03d}" for i in range(300)]
    rare = 1 / np.arange(1, 301)
    texts = [" ".join(dice.choice(words, dice.integers(5, 60), p=rare / rare.sum())) for _ in range(n)]
    documents = spark.createDataFrame(list(enumerate(texts)), "document_id LONG, text STRING")
    asked = [(i, " ".join(dice.choice(words[150:], 3)) + " " + words[i % 5]) for i in range(12)] + [(90, "inconnu"), (91, ""), (92, texts[7])]
    return documents, spark.createDataFrame(asked, "query_id LONG, text STRING")


def test_pruned_search_skips_blocks_and_changes_nothing(spark):
    documents, queries = _random_corpus(spark)
    index = retrieval.build_index(documents, block_documents=8)
    for k in (1, 5):
        whole = retrieval.rank(retrieval.cosine_scores(queries, index), "query_id", "document_id", k)
        assert sorted(map(tuple, retrieval.search(queries, index, k=k).collect())) == sorted(map(tuple, whole.collect()))
    asked = retrieval._asked(queries, index, "query_id", "text")
    bounds = retrieval.block_bounds(asked, index, "query_id")
    chosen = retrieval.reachable_blocks(asked, index, "query_id", 1)
    rows = [retrieval.block_scores(asked, pairs, index, "query_id").count() for pairs in (bounds, chosen)]
    assert rows[1] < rows[0] / 2
    scored = retrieval.block_scores(asked, bounds, index, "query_id").join(bounds, ["query_id", "block"])
    assert scored.filter("score > bound + 1e-9").count() == 0


def test_scoring_deals_the_index_by_block_once(spark):
    documents, queries = _random_corpus(spark, 60)
    index = retrieval.build_index(documents, block_documents=8)
    asked = retrieval._asked(queries, index, "query_id", "text")
    chosen = retrieval.reachable_blocks(asked, index, "query_id", 5)
    scored = retrieval.block_scores(asked, chosen, index, "query_id")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    dealt = set(re.findall(r"hashpartitioning\(([^)]*)\)", plan))
    assert any(re.fullmatch(r"block#\d+L?, \d+", d) for d in dealt)
    # Neither the join on (block, term) nor the sums by (block, query, document) deal the rows again.
    assert not any(re.match(r"(block|term)#\d+L?, [a-z_]+#", d) for d in dealt)


def test_lengths_need_one_shuffle_of_hashes_and_agree_with_the_weights(spark):
    """Repeated terms, an empty and a null text, and two rows of one key; no text of a term is shuffled for the lengths."""
    rows = [("a", "un prix prix remise prix remise"), ("b", ""), ("c", None), ("d", "prix delai"), ("d", "delai remise"), ("e", "x y")]
    documents = spark.createDataFrame(rows, "document_id STRING, text STRING")
    index = retrieval.build_index(documents, block_documents=2)
    expected = retrieval.document_weights(index).groupBy("document_id").agg(F.count("*"), F.sum("weight"), F.max("weight"), F.sum(F.col("weight") * F.col("weight")))
    got = {r[0]: tuple(r[1:]) for r in retrieval.weight_totals(index).collect()}
    assert got == {r[0]: pytest.approx(tuple(r[1:4])) for r in expected.collect()} and sorted(got) == ["a", "d"]
    assert all(r[4] == pytest.approx(1.0) for r in expected.collect())
    assert got["d"][0] == 5  # prix, delai, remise and the pairs inside each row
    plan = retrieval._lengths(index)._jdf.queryExecution().executedPlan().toString()
    # One for the rows of a key, one for the hashes, one for the sums.
    assert len(re.findall(r"Exchange ", plan)) == 3 and "term" not in "".join(re.findall(r"Exchange [^\n]*", plan))
    asked = spark.createDataFrame([("prix",), ("delai",)], "term STRING")
    assert {(r.term, r.df) for r in index.frequencies_of(asked).collect()} == {("prix", 2), ("delai", 1)}
