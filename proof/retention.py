"""Groups L (priority), M (recommendations), N (KPIs) and P (signals)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from holdfast.functions.numeric import even_round, number_or
from holdfast.operators import kpi, marts, priority, recommend, signals
from holdfast.operators.preprocess import class_distribution
from holdfast.schemas import SPLIT_ORDER
from proof.base import Tables, ev, fx, register

KEYS = ("observation_date", "customer_id")
_KEY_SQL = "CAST(observation_date AS VARCHAR) AS observation_date, customer_id"
_QUEUE_SQL = "CAST(observation_date AS VARCHAR) AS observation_date, strftime(scored_at, '%Y-%m-%d %H:%M:%S') AS scored_at, * EXCLUDE (observation_date, scored_at)"

# --- L: priority ---------------------------------------------------------------------------------


def _candidate(**columns):
    return lambda t: t.candidates.select(*KEYS, *[make().alias(n) for n, make in columns.items()])


register("l01_numeric_defaults", lambda t: t.candidates.select(*KEYS, number_or("renewal_days_min", 0.0).alias("renewal_days"), number_or("avg_satisfaction_score_12m", 0.0).alias("satisfaction")),
         f"SELECT {_KEY_SQL}, CAST(coalesce(renewal_days_min, 0) AS DOUBLE) AS renewal_days, coalesce(avg_satisfaction_score_12m, 0) AS satisfaction FROM cand")
register("l02_value_score", lambda t: priority.with_value_score(t.candidates).select(*KEYS, "value_score"),
         f"SELECT {_KEY_SQL}, round(value_score, 9) AS value_score FROM ranked", 9)
register("l03_propensity", _candidate(propensity=lambda: even_round(priority.propensity(), 4)), f"SELECT {_KEY_SQL}, {ev('propensity', 4)} AS propensity FROM ranked")
register("l04_urgency", _candidate(urgency=priority.urgency), f"SELECT {_KEY_SQL}, CAST(urgency AS DOUBLE) AS urgency FROM ranked")
register("l05_business_score", _candidate(business=lambda: even_round(priority.business_score(), 4)), f"SELECT {_KEY_SQL}, {ev('business', 4)} AS business FROM ranked")
for key, columns in (
    ("l06_priority_score", "priority_score"),
    ("l07_saved_value", "estimated_annual_value retention_propensity expected_saved_value"),
    ("l08_tier", "priority_score priority_tier"),
    ("l09_action", "recommended_action_type"),
    ("l10_channel", "recommended_channel"),
    ("l11_offer_value", "priority_tier estimated_offer_value"),
    ("l12_action_reason", "action_reason"),
    ("l13_business_context", "business_context"),
):
    register(key, lambda t, c=columns.split(): t.queue.select(*KEYS, *c), f"SELECT {_KEY_SQL}, {', '.join(columns.split())} FROM queue")
register("l10_channel_by_code", _candidate(channel=lambda: priority.channel(match_codes=True)), f"""
SELECT {_KEY_SQL}, CASE
  WHEN preferred_channel_code = 'RETENTION_OUTBOUND' AND consent_phone THEN 'PHONE'
  WHEN preferred_channel_code IN ('EMAIL', 'WEB', 'MOBILE') AND consent_email THEN 'EMAIL'
  WHEN preferred_channel_code = 'SMS' AND consent_sms THEN 'SMS'
  WHEN consent_phone THEN 'PHONE' WHEN consent_email THEN 'EMAIL' WHEN consent_sms THEN 'SMS' ELSE 'AGENCY_TASK' END AS channel FROM cand""")
register("l14_queue_order", lambda t: priority.ordered_queue(t.queue, 100), f"""
SELECT {_QUEUE_SQL} FROM queue ORDER BY priority_score DESC, expected_saved_value DESC, churn_probability DESC, customer_id, observation_date LIMIT 100""")
register("l14_full_queue", lambda t: priority.ordered_queue(t.queue), f"SELECT {_QUEUE_SQL} FROM queue")
register("l15_empty_queue", lambda t: priority.score(t.candidates.filter(F.col("split_name") == "none")), f"SELECT {_QUEUE_SQL} FROM queue WHERE false")

# --- M: recommendations --------------------------------------------------------------------------

register("m01_queue_for_review", lambda t: recommend.queue_for_review(t.queue).select(*KEYS, "priority_tier", "priority_score"), f"""
SELECT {_KEY_SQL}, priority_tier, priority_score FROM queue WHERE priority_tier IN ('CRITICAL', 'HIGH', 'MEDIUM')
ORDER BY priority_score DESC, expected_saved_value DESC, queue.customer_id, queue.observation_date""")
register("m02_strategy_lookup", lambda t: recommend.with_strategy(t.queue, recommend.strategy_catalog(t.spark)).select(
    *KEYS, "recommended_action_type", "offer_label", "message_template", "default_next_step"
), f"""
SELECT {_KEY_SQL}, recommended_action_type, offer AS offer_label, message AS message_template, step AS default_next_step
FROM queue JOIN strategy ON action = recommended_action_type""")
for key, columns in (
    ("m03_recommendation_id", "recommendation_id"),
    ("m04_offer_text", "recommendation_id recommended_offer"),
    ("m05_advisor_message", "recommendation_id advisor_message"),
    ("m06_decision_rationale", "recommendation_id decision_rationale"),
    ("m07_review_fields", "recommendation_id next_best_step approval_decision approval_comment"),
):
    register(key, lambda t, c=columns.split(): recommend.recommend(t.queue).select(*KEYS, *c), f"SELECT {_KEY_SQL}, {', '.join(columns.split())} FROM rec")
register("m07_recommendations", lambda t: recommend.recommend(t.queue),
         "SELECT CAST(observation_date AS VARCHAR) AS observation_date, 'PENDING_REVIEW' AS human_review_status, * EXCLUDE (observation_date, created_at, human_review_status) FROM rec")
register("m08_contact_drafts", lambda t: recommend.contact_drafts(t.recommendations), """
SELECT recommendation_id, customer_id, 'Let''s review your policy' AS subject, recommended_channel AS channel, true AS requires_human_approval,
  'Hello ' || first_name || ' ' || last_name || ',' || chr(10) || chr(10)
  || 'We would like to review your policy with you to make sure your coverage still matches your current needs.' || chr(10) || chr(10)
  || 'Recommended offer: ' || recommended_offer || '.' || chr(10) || 'Advisor context: ' || decision_rationale || chr(10)
  || 'Next step: ' || next_best_step || chr(10) || chr(10)
  || 'This message is a draft and must be approved by an advisor before sending.' AS body FROM rec""")

# --- N: KPIs -------------------------------------------------------------------------------------

_RATES = """
SELECT split_name, count(*) AS rows, sum(churn_label)::BIGINT AS churn_rows, round(avg(churn_label), 4) AS churn_rate FROM lab GROUP BY split_name"""
register("n01_churn_rate_by_split", lambda t: kpi.churn_rates(t.labels), _RATES)
register("n02_split_distribution", lambda t: kpi.churn_rates(t.labels, SPLIT_ORDER), _RATES)
_MICRO = "round(CAST(sum(CAST(round(churn_probability * 1e6) AS BIGINT)) AS DOUBLE) / count(*) / 1e6, 4) AS avg_churn_probability"
_CENTS = "CAST(sum(CAST(round(expected_saved_value * 100) AS BIGINT)) AS DOUBLE) / 100"
for key, by in (("n03_priority_by_region", ["region"]), ("n04_priority_by_agency", ["agency_name", "region"])):
    register(key, lambda t, b=by: kpi.priority_clients(t.queue, b), f"""
SELECT {', '.join(by)}, priority_tier, count(*) AS clients, {_MICRO}, {_CENTS} AS expected_saved_value FROM queue
GROUP BY {', '.join(by)}, priority_tier""")
_SCORE = "round(CAST(sum(CAST(round(priority_score * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100, 2)"
register("n05_action_distribution", lambda t: kpi.action_distribution(t.recommendations), f"""
SELECT recommended_action_type, recommended_channel, count(*) AS recommendations, {_SCORE} AS avg_priority_score, {_MICRO} FROM rec
GROUP BY ALL""")
register("n06_weekly_contacts", lambda t: kpi.weekly_contacts(t.queue, t.recommendations, F.lit(dt.date(2001, 7, 11))), f"""
SELECT agency_name, region, count(*) AS customers_to_contact,
  round(CAST(sum(CAST(round(q.churn_probability * 1e6) AS BIGINT)) AS DOUBLE) / count(*) / 1e6, 4) AS avg_churn_probability,
  round(avg(CASE WHEN human_review_status = 'APPROVED' THEN 1 ELSE 0 END), 4) AS approved_action_rate
FROM queue q LEFT JOIN rec r ON r.customer_id = q.customer_id AND r.observation_date = q.observation_date AND r.mlflow_run_id = q.mlflow_run_id
WHERE scored_at >= date_trunc('week', DATE '2001-07-11') GROUP BY agency_name, region""")
register("n07_customer_count", lambda t: kpi.customer_count(t.dim_customer), "SELECT count(DISTINCT customer_id) AS total_customers FROM cust")
register("n08_top_priority_clients", lambda t: kpi.top_priority_clients(t.queue, 5), """
SELECT customer_id, first_name, last_name, split_name, region, agency_name, main_product_family, priority_tier, priority_score, churn_probability,
  expected_saved_value, recommended_action_type, recommended_channel, action_reason, business_context, mlflow_run_id
FROM queue ORDER BY priority_score DESC, expected_saved_value DESC, churn_probability DESC, customer_id, split_name LIMIT 5""")
register("n09_top_recommendations", lambda t: kpi.top_recommendations(t.recommendations, 5), """
SELECT recommendation_id, customer_id, first_name, last_name, priority_tier, priority_score, churn_probability, expected_saved_value,
  recommended_action_type, recommended_channel, recommended_offer, estimated_offer_value, advisor_message, decision_rationale, next_best_step,
  human_review_status, mlflow_run_id
FROM rec ORDER BY priority_score DESC, expected_saved_value DESC, churn_probability DESC, recommendation_id LIMIT 5""")
for key, source, view, keys, means, sums in (
    ("n10_candidate_volume", "candidates", "cand", ["split_name"], ["churn_probability", "total_annual_premium"], []),
    ("n11_queue_summary", "queue", "queue", ["split_name", "priority_tier"], ["priority_score", "churn_probability"], ["expected_saved_value"]),
    ("n12_action_summary", "queue", "queue", ["recommended_action_type", "recommended_channel"], ["priority_score"], ["expected_saved_value"]),
    ("n13_tier_overview", "queue", "queue", ["priority_tier"], ["priority_score", "churn_probability"], ["expected_saved_value"]),
    ("n14_recommendation_summary", "recommendations", "rec", ["priority_tier", "recommended_action_type"], ["priority_score"], ["expected_saved_value"]),
):
    register(
        key, lambda t, s=source, k=keys, m=means, u=sums: kpi.volume_summary(getattr(t, s), k, m, u),
        f"SELECT {', '.join(keys)}, count(*) AS rows" + "".join(f", round(avg({c}), 6) AS avg_{c}" for c in means)
        + "".join(f", round(sum({c}), 6) AS total_{c}" for c in sums) + f" FROM {view} GROUP BY {', '.join(keys)}", 6,
    )
register("n15_label_distribution", lambda t: class_distribution(t.labels), """
SELECT split_name, churn_label, count(*) AS rows, CAST(sum(count(*)) OVER (PARTITION BY split_name) AS BIGINT) AS total_rows,
  round(count(*) / sum(count(*)) OVER (PARTITION BY split_name), 8) AS share FROM lab GROUP BY split_name, churn_label""", 8)
register("n16_chart_rows", lambda t: kpi.chart_rows(kpi.volume_summary(t.queue, ["region", "priority_tier"], count="clients"), "region", "clients"),
         "SELECT region, priority_tier, count(*) AS clients FROM queue GROUP BY ALL")
register("n17_leading_category", lambda t: kpi.leading_category(kpi.volume_summary(t.queue, ["region"], count="clients"), "region", "clients"),
         "SELECT region, count(*) AS clients FROM queue GROUP BY ALL ORDER BY clients DESC, region LIMIT 1")

# --- P: signals ----------------------------------------------------------------------------------


def _profiles(t: Tables):
    return t.candidates.join(t.queue.select(*KEYS, "action_reason", "recommended_action_type"), list(KEYS))


_SIGNALS_SQL = f"""
WITH found AS (
  SELECT observation_date, customer_id, 1 AS pos, 'price_sensitivity_score' AS field, 'sensibilite prix elevee' AS label,
    CAST({ev('price_sensitivity_score', 3)} AS VARCHAR) AS value,
    {ev('least(abs(price_sensitivity_score - 0.65e0) + 0.5e0, 1)', 3)} AS severity FROM tiered WHERE price_sensitivity_score > 0.65e0
  UNION ALL SELECT observation_date, customer_id, 2, 'avg_satisfaction_score_12m', 'satisfaction faible sur 12 mois', CAST({ev('avg_satisfaction_score_12m', 3)} AS VARCHAR),
    {ev('least(abs(avg_satisfaction_score_12m - 3.5e0) / 3.5e0 + 0.5e0, 1)', 3)} FROM tiered WHERE avg_satisfaction_score_12m <= 3.5e0
  UNION ALL SELECT observation_date, customer_id, 3, 'renewal_days_min', 'renouvellement proche', {fx('renewal_days_min', 0)} || ' jours',
    {ev('least(abs(CAST(renewal_days_min AS DOUBLE) - 45) / 45 + 0.5e0, 1)', 3)} FROM tiered WHERE renewal_days_min <= 45
  UNION ALL SELECT observation_date, customer_id, 4, 'days_since_last_contact', 'pas de contact recent', {fx('days_since_last_contact', 0)} || ' jours',
    {ev('least(abs(CAST(days_since_last_contact AS DOUBLE) - 90) / 90 + 0.5e0, 1)', 3)} FROM tiered WHERE days_since_last_contact > 90
  UNION ALL SELECT observation_date, customer_id, 5, 'payment_incidents_6m', 'incidents de paiement recents', CAST({ev('payment_incidents_6m', 3)} AS VARCHAR), 1e0 FROM tiered WHERE payment_incidents_6m > 0
  UNION ALL SELECT observation_date, customer_id, 6, 'complaints_6m', 'reclamations recentes', CAST({ev('complaints_6m', 3)} AS VARCHAR), 1e0 FROM tiered WHERE complaints_6m > 0
  UNION ALL SELECT observation_date, customer_id, 0, 'action_reason', action_reason, action_reason, 0.95e0 FROM tiered),
placed AS (SELECT *, row_number() OVER (PARTITION BY observation_date, customer_id ORDER BY severity DESC, pos) AS rank FROM found)
"""
register("p01_customer_signals", lambda t: signals.customer_signals(t.candidates), _SIGNALS_SQL.replace(
    "UNION ALL SELECT observation_date, customer_id, 0, 'action_reason', action_reason, action_reason, 0.95e0 FROM tiered", ""
) + f"SELECT {_KEY_SQL}, rank, field, label, value, severity, 'risk' AS direction FROM placed")
register("p02_top_signals", lambda t: signals.customer_signals(_profiles(t), 4),
         _SIGNALS_SQL + f"SELECT {_KEY_SQL}, rank, field, label, value, severity, 'risk' AS direction FROM placed WHERE rank <= 4")
_DERIVED = "CASE WHEN churn_probability >= 0.75e0 THEN 'VERY_HIGH' WHEN churn_probability >= 0.5e0 THEN 'HIGH' WHEN churn_probability >= 0.25e0 THEN 'MEDIUM' ELSE 'LOW' END"
register("p03_probability_view", lambda t: signals.probability_view(t.candidates), f"""
SELECT {_KEY_SQL}, mlflow_run_id, churn_probability AS probability, {fx('churn_probability * 100', 0)} || '%' AS probability_label,
  churn_risk_band AS risk_band,
  CASE churn_risk_band WHEN 'VERY_HIGH' THEN 'tres eleve' WHEN 'HIGH' THEN 'eleve' WHEN 'MEDIUM' THEN 'moyen' ELSE 'faible' END AS risk_band_label,
  CASE WHEN churn_probability >= 0.75e0 THEN 'risque tres eleve' WHEN churn_probability >= 0.5e0 THEN 'risque eleve'
    WHEN churn_probability >= 0.25e0 THEN 'risque moyen' ELSE 'risque faible a surveiller' END AS probability_interpretation,
  {_DERIVED} AS derived_risk_band,
  CASE WHEN churn_risk_band <> {_DERIVED} THEN 'La table retourne une bande ' || churn_risk_band || ', alors que la probabilite correspond a '
    || {_DERIVED} || '; verifier la calibration ou la definition de la bande.' END AS consistency_note FROM cand""")
register("p04_band_agreement", lambda t: signals.band_agreement(t.candidates), f"""
SELECT churn_risk_band AS risk_band, {_DERIVED} AS derived_risk_band, count(*) AS rows, churn_risk_band = {_DERIVED} AS consistent FROM cand GROUP BY ALL""")


def _importance(t: Tables):
    """Four fixed-order drivers weighted by their mean over the candidates."""
    from holdfast.operators.explain import rank_importance

    names = ("price_sensitivity_score", "loyalty_score", "complaints_6m", "tenure_months")
    means = t.candidates.agg(*[F.avg(n).alias(n) for n in names]).unpivot([], list(names), "feature", "mean_abs_shap")
    return rank_importance(means.select(
        "feature", F.lit("numeric").alias("feature_type"), "mean_abs_shap",
        F.when(F.col("feature") == "loyalty_score", -F.col("mean_abs_shap")).otherwise(F.col("mean_abs_shap")).alias("mean_shap"),
        F.lit(0.5).alias("positive_impact_share"),
    ))


register("p05_customer_drivers", lambda t: signals.customer_drivers(
    t.candidates.select(*KEYS, "price_sensitivity_score", "complaints_6m", "tenure_months"), _importance(t), 3
).withColumn("customer_value", F.col("customer_value").cast("double")), f"""
WITH means AS (
  SELECT avg(price_sensitivity_score) AS a, avg(loyalty_score) AS b, avg(complaints_6m) AS c, avg(tenure_months) AS d FROM cand),
drivers AS (
  SELECT *, row_number() OVER (ORDER BY m DESC, feature) AS rank, {ev('m / sum(m) OVER () * 100', 1)} AS importance_pct FROM (
    SELECT 'price_sensitivity_score' AS feature, a AS m, 'sensibilite au prix' AS label FROM means
    UNION ALL SELECT 'loyalty_score', b, 'score de fidelite' FROM means UNION ALL SELECT 'complaints_6m', c, 'complaints 6m' FROM means
    UNION ALL SELECT 'tenure_months', d, 'tenure months' FROM means))
SELECT {_KEY_SQL}, rank, feature, label, CASE feature WHEN 'loyalty_score' THEN 'decreases_churn_risk' ELSE 'increases_churn_risk' END AS impact_direction,
  importance_pct, CASE feature WHEN 'price_sensitivity_score' THEN price_sensitivity_score WHEN 'complaints_6m' THEN complaints_6m
    WHEN 'tenure_months' THEN tenure_months END AS customer_value, feature <> 'loyalty_score' AS feature_available_for_customer
FROM cand CROSS JOIN drivers WHERE rank <= 3""")
register("p06_recommended_action", lambda t: marts.queue_with_recommendations(t.queue, t.recommendations).join(
    t.recommendations.select("recommendation_id", "next_best_step", "advisor_message"), "recommendation_id"
).withColumn("next_best_step", F.when(F.col("priority_tier") == "LOW", "").otherwise(F.col("next_best_step"))).select(
    *KEYS, signals.recommended_action(["next_best_step", "advisor_message", "recommended_action_type"]).alias("action")
), f"SELECT {_KEY_SQL}, CASE WHEN priority_tier = 'LOW' THEN advisor_message ELSE next_best_step END AS action FROM rec")
