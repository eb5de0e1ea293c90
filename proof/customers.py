"""Groups C (marts), D (snapshot, labels, life cycle) and E (features)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from holdfast.functions.numeric import even_round
from holdfast.operators import features, lifecycle, marts, snapshot
from holdfast.sources.sample_tables import SAMPLE_DATES
from proof.base import Tables, ev, register

KEYS = ("observation_date", "customer_id")
_KEY_SQL = "CAST(observation_date AS VARCHAR) AS observation_date, customer_id"
_SNAPSHOT_SQL = "CAST(observation_date AS VARCHAR) AS observation_date, * EXCLUDE (observation_date)"

# --- C: joins and marts ----------------------------------------------------------------------------

register("c01_training_mart", lambda t: t.mart, """
SELECT CAST(observation_date AS VARCHAR) AS observation_date, CAST(churn_date AS VARCHAR) AS churn_date,
  CAST(birth_date AS VARCHAR) AS birth_date, CAST(acquisition_date AS VARCHAR) AS acquisition_date,
  * EXCLUDE (observation_date, churn_date, birth_date, acquisition_date) FROM mart""")
register("c02_latest_run", lambda t: marts.latest_run(t.predictions), """
SELECT arg_max(mlflow_run_id, scored_at) AS mlflow_run_id, strftime(max(scored_at), '%Y-%m-%d %H:%M:%S') AS scored_at FROM pred""")
_CAND_SQL = """
SELECT CAST(observation_date AS VARCHAR) AS observation_date, strftime(scored_at, '%Y-%m-%d %H:%M:%S') AS scored_at,
  * EXCLUDE (observation_date, scored_at, active_auto_policy_count, active_home_policy_count, active_health_policy_count,
    active_life_policy_count, cancelled_policy_count_to_date, policy_age_avg_months, customer_age_years, latent_churn_risk_band)
FROM cand"""
register("c03_candidate_mart", lambda t: marts.candidate_mart(
    t.predictions, t.snapshot, t.dim_customer, t.dim_channel, t.dim_agency, t.dim_geography
), _CAND_SQL)
_PROFILE_COLUMNS = """
  c.customer_id, c.first_name, c.last_name, c.customer_segment, c.estimated_income_band, c.digital_profile, c.price_sensitivity_score,
  c.service_sensitivity_score, c.loyalty_score, c.consent_email, c.consent_sms, c.consent_phone, a.agency_name, g.region,
  s.observation_date, s.tenure_months, s.active_policy_count, s.number_of_products, s.total_annual_premium, s.payment_incidents_6m,
  s.complaints_6m, s.days_since_last_contact, s.avg_satisfaction_score_12m, s.renewal_days_min, p.churn_probability,
  p.churn_risk_band, CAST(p.predicted_churn_label AS DOUBLE) AS predicted_churn_label, p.mlflow_run_id, q.priority_tier, q.priority_score, q.recommended_action_type,
  q.recommended_channel, q.action_reason, r.recommended_offer, r.advisor_message, r.next_best_step"""
_PROFILE_FROM = """
FROM cust c JOIN agency a ON a.agency_id = c.home_agency_id JOIN geo g ON g.geography_id = c.geography_id
LEFT JOIN snap s ON s.customer_id = c.customer_id
LEFT JOIN pred p ON p.customer_id = c.customer_id AND p.observation_date = s.observation_date
LEFT JOIN queue q ON q.customer_id = c.customer_id AND q.observation_date = s.observation_date AND q.mlflow_run_id = p.mlflow_run_id
LEFT JOIN rec r ON r.customer_id = c.customer_id AND r.observation_date = s.observation_date AND r.mlflow_run_id = p.mlflow_run_id"""


def _profiles(t: Tables, run_id: str | None = None):
    profiles = marts.customer_profiles(
        t.dim_customer, t.dim_agency, t.dim_geography, t.snapshot, t.predictions, t.queue, t.recommendations, run_id
    )
    return profiles.withColumn("predicted_churn_label", F.col("predicted_churn_label").cast("double"))


register("c04_customer_profiles", _profiles, f"""
WITH profiles AS (SELECT {_PROFILE_COLUMNS} {_PROFILE_FROM})
SELECT CAST(observation_date AS VARCHAR) AS observation_date, * EXCLUDE (observation_date) FROM profiles""")
register("c05_latest_per_customer", lambda t: marts.latest_per_customer(_profiles(t)), f"""
WITH profiles AS (SELECT {_PROFILE_COLUMNS} {_PROFILE_FROM})
SELECT CAST(observation_date AS VARCHAR) AS observation_date, * EXCLUDE (observation_date) FROM profiles
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY observation_date DESC NULLS LAST, mlflow_run_id DESC NULLS LAST) = 1""")
register("c06_customer_lookup", lambda t: marts.customers_in(t.dim_customer, t.dim_agency, t.dim_geography, region="europe").unionByName(
    marts.customers_in(t.dim_customer, t.dim_agency, t.dim_geography, city="NATION_3")
), """
SELECT c.customer_id, first_name, last_name, customer_segment, digital_profile, agency_name, city, region
FROM cust c JOIN agency ON agency_id = home_agency_id JOIN geo g ON g.geography_id = c.geography_id WHERE lower(region) = 'europe'
UNION ALL
SELECT c.customer_id, first_name, last_name, customer_segment, digital_profile, agency_name, city, region
FROM cust c JOIN agency ON agency_id = home_agency_id JOIN geo g ON g.geography_id = c.geography_id WHERE lower(city) = 'nation_3'""")
register("c07_queue_with_recommendations", lambda t: marts.queue_with_recommendations(t.queue, t.recommendations).select(
    *KEYS, "mlflow_run_id", "priority_score", "recommendation_id", "human_review_status"
), """
SELECT CAST(q.observation_date AS VARCHAR) AS observation_date, q.customer_id, q.mlflow_run_id, q.priority_score, recommendation_id, human_review_status
FROM queue q LEFT JOIN rec r ON r.customer_id = q.customer_id AND r.observation_date = q.observation_date AND r.mlflow_run_id = q.mlflow_run_id""")
register("c08_spine", lambda t: snapshot.spine(t.dim_customer.select("customer_id"), SAMPLE_DATES), """
SELECT CAST(o AS VARCHAR) AS observation_date, split_name, customer_id FROM cust CROSS JOIN dates""")
register("c09_started_policies", lambda t: snapshot.expand_to_dates(
    t.fact_policy.select("policy_id", "customer_id", "policy_start_date"), "policy_start_date", SAMPLE_DATES
), """
SELECT policy_id, customer_id, CAST(start_date AS VARCHAR) AS policy_start_date, CAST(o AS VARCHAR) AS observation_date
FROM policy JOIN dates ON start_date <= o""")
register("c10_lookback_payments", lambda t: snapshot.expand_to_dates(
    t.fact_payment.select("customer_id", "due_date", "payment_status"), "due_date", SAMPLE_DATES, snapshot.HALF_YEAR_DAYS
).groupBy("customer_id", "observation_date", "payment_status").agg(
    F.count(F.lit(1)).alias("payments"), F.min("due_date").alias("first_due"), F.max("due_date").alias("last_due")
), """
SELECT customer_id, CAST(o AS VARCHAR) AS observation_date, status AS payment_status, count(*) AS payments,
  CAST(min(day) AS VARCHAR) AS first_due, CAST(max(day) AS VARCHAR) AS last_due
FROM payment JOIN dates ON day >= o - 183 AND day <= o GROUP BY ALL""")
register("c11_forward_cancellations", lambda t: snapshot.expand_to_dates(
    t.fact_policy.filter("cancellation_date IS NOT NULL").select("customer_id", "policy_start_date", "cancellation_date"),
    "cancellation_date", SAMPLE_DATES, ahead_days=90,
).filter("policy_start_date <= observation_date").groupBy("customer_id", "observation_date").agg(F.min("cancellation_date").alias("churn_date")), """
SELECT customer_id, CAST(o AS VARCHAR) AS observation_date, CAST(min(cancelled_on) AS VARCHAR) AS churn_date
FROM policy JOIN dates ON cancelled_on > o AND cancelled_on <= o + 90 AND start_date <= o GROUP BY ALL""")
register("c12_lookup_with_default", lambda t: marts.with_default(
    t.fact_interaction.select("interaction_id", F.col("interaction_type").alias("kind")),
    t.spark.sql("SELECT * FROM VALUES ('click', 'Digital', 1), ('error', 'Complaint', 5), ('other', 'Unknown', 0) AS t(kind, label, weight)"),
    "kind", "other",
).groupBy("kind", "label", "weight").agg(F.count(F.lit(1)).alias("rows")), """
SELECT event_type AS kind, CASE event_type WHEN 'click' THEN 'Digital' WHEN 'error' THEN 'Complaint' ELSE 'Unknown' END AS label,
  CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 5 ELSE 0 END AS weight, count(*) AS rows FROM contact GROUP BY ALL""")
register("c13_product_tiers", lambda t: marts.product_tiers(t.fact_policy, t.dim_product).groupBy("product_id", "coverage_tier").agg(
    F.count(F.lit(1)).alias("policies")
), "SELECT 'PROD_' || family || '_' || coverage_tier AS product_id, coverage_tier, count(*) AS policies FROM policy GROUP BY ALL")
register("c14_scores_on_keys", lambda t: t.predictions.join(t.labels.select(*KEYS, "churn_label"), list(KEYS)).select(
    *KEYS, "mlflow_run_id", "churn_probability", "churn_label"
), """
SELECT CAST(observation_date AS VARCHAR) AS observation_date, customer_id, mlflow_run_id, p.churn_probability, churn_label
FROM pred p JOIN lab USING (observation_date, customer_id)""")
register("c16_agencies_by_customers", lambda t: marts.agencies_by_customers(t.dim_customer, t.dim_agency, t.dim_geography, 10), """
SELECT agency_name, region, count(*) AS customers FROM cust c JOIN agency a ON a.agency_id = c.home_agency_id
JOIN geo g ON g.geography_id = a.geography_id GROUP BY ALL ORDER BY customers DESC, agency_name, region LIMIT 10""")
register("c17_contacts_this_week", lambda t: marts.contacts_this_week(t.recommendations, t.dim_customer, t.dim_agency, F.lit(dt.date(2001, 7, 11))), """
SELECT agency_name, count(*) AS contacted_customers, round(avg(CASE WHEN human_review_status = 'APPROVED' THEN 1 ELSE 0 END), 8) AS approved_action_rate
FROM rec r JOIN cust c ON c.customer_id = r.customer_id JOIN agency a ON a.agency_id = c.home_agency_id
WHERE created_at >= date_trunc('week', DATE '2001-07-11') GROUP BY agency_name""", 8)

# --- D: one key per snapshot column group --------------------------------------------------------

_POLICY_FACTS = ("policies",)
for key, columns, facts in (
    ("d01_tenure_months", "tenure_months", ()),
    ("d02_customer_age_years", "customer_age_years", ()),
    ("d03_active_policy_count", "active_policy_count", _POLICY_FACTS),
    ("d04_number_of_products", "number_of_products", _POLICY_FACTS),
    ("d05_family_counts", "active_auto_policy_count active_home_policy_count active_health_policy_count active_life_policy_count", _POLICY_FACTS),
    ("d06_total_annual_premium", "total_annual_premium", _POLICY_FACTS),
    ("d07_premium_increase_max", "premium_increase_pct_max_12m", _POLICY_FACTS),
    ("d08_main_product_family", "main_product_family", _POLICY_FACTS),
    ("d09_highest_coverage_tier", "highest_coverage_tier", _POLICY_FACTS),
    ("d10_policy_age_avg_months", "policy_age_avg_months", _POLICY_FACTS),
    ("d11_cancelled_to_date", "cancelled_policy_count_to_date", _POLICY_FACTS),
    ("d12_renewal_days_min", "renewal_days_min", _POLICY_FACTS),
    ("d13_late_payments", "late_payment_count_12m", ("payments",)),
    ("d14_rejected_payments", "rejected_payment_count_12m", ("payments",)),
    ("d15_service_cases", "service_case_count_12m unresolved_case_count_12m", ("cases",)),
    ("d16_retention_offers", "retention_offer_count_12m retention_acceptance_rate_12m", ("actions",)),
    ("d17_quotes", "quote_count_6m competitor_price_index_avg_6m", ("quotes",)),
    ("d18_campaign_response", "campaign_response_rate_6m", ("campaigns",)),
    ("d19_avg_satisfaction", "avg_satisfaction_score_12m", ("cases",)),
    ("d20_customer_value", "customer_value_score", _POLICY_FACTS),
    ("d21_claims", "total_claims_12m total_claim_amount_12m", ("claims",)),
    ("d22_recent_events", "payment_incidents_6m complaints_6m interactions_3m", ("payments", "cases", "interactions")),
    ("d23_days_since_last_contact", "days_since_last_contact", ("interactions",)),
    ("d24_digital_sessions", "digital_sessions_30d", ("interactions",)),
    ("d25_email_open_rate", "email_open_rate_6m", ("campaigns",)),
):
    register(
        key, lambda t, f=facts, c=columns.split(): t.wide_of(*f).select(*KEYS, *c),
        f"SELECT {_KEY_SQL}, {', '.join(columns.split())} FROM snap", {"customer_value_score": 4},
    )
register("d00_full_snapshot", lambda t: t.snapshot, f"SELECT {_SNAPSHOT_SQL} FROM snap")
register("d03_active_as_of", lambda t: t.wide_of("policies", status_as_of=True).select(*KEYS, "active_policy_count", "total_annual_premium"), """
SELECT CAST(d.o AS VARCHAR) AS observation_date, c.customer_id,
  count(p.k) AS active_policy_count, coalesce(CAST(sum(p.premium) AS DOUBLE), 0) AS total_annual_premium
FROM cust c CROSS JOIN dates d LEFT JOIN policy p ON p.customer_id = c.customer_id AND p.start_date <= d.o AND p.end_date >= d.o
  AND (p.cancelled_on IS NULL OR p.cancelled_on > d.o) GROUP BY ALL""")
register("d26_churn_label", lambda t: t.wide_of("policies").select(*KEYS, "churn_label", "churn_date", "customer_lifecycle_status"),
         f"SELECT {_KEY_SQL}, churn_label, CAST(churn_date AS VARCHAR) AS churn_date, customer_lifecycle_status FROM lab")
register("d27_churn_score", lambda t: t.wide.select(*KEYS, even_round("raw_churn_probability", 6).alias("churn_probability")),
         f"SELECT {_KEY_SQL}, {ev('prob', 6)} AS churn_probability FROM scored")
register("d28_label_band", lambda t: t.labels.groupBy("split_name", "churn_risk_band").agg(F.count(F.lit(1)).alias("rows")),
         "SELECT split_name, churn_risk_band, count(*) AS rows FROM lab GROUP BY ALL")
register("d29_label_reason", lambda t: t.labels.select(*KEYS, "label_reason"), f"SELECT {_KEY_SQL}, label_reason FROM lab")
register("d30_lifetime_totals", lambda t: lifecycle.lifetime_totals(
    t.dim_customer, t.fact_policy, t.fact_payment, t.fact_claim, t.fact_customer_service, t.fact_interaction
), """
WITH p AS (SELECT customer_id, count(*) AS n, CAST(sum(premium) FILTER (status = 'ACTIVE') AS DOUBLE) AS premium FROM policy GROUP BY ALL),
y AS (SELECT customer_id, count(*) AS n FROM payment WHERE status <> 'PAID' GROUP BY ALL),
l AS (SELECT customer_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM claim GROUP BY ALL),
v AS (SELECT customer_id, count(*) AS n, count(*) FILTER (complaint) AS complaints, sum(score) AS score FROM svc GROUP BY ALL),
i AS (SELECT customer_id, count(*) AS n, count(*) FILTER (e % 9 < 2) AS digital FROM contact GROUP BY ALL)
SELECT c.customer_id, coalesce(p.n, 0) AS policy_count, coalesce(premium, 0) AS premium, coalesce(y.n, 0) AS payment_incidents,
  coalesce(l.n, 0) AS claims, coalesce(amount, 0) AS claim_amount, coalesce(complaints, 0) AS complaints,
  coalesce(score, 0) AS service_satisfaction_sum, coalesce(v.n, 0) AS service_satisfaction_count,
  coalesce(i.n, 0) AS interactions, coalesce(digital, 0) AS digital_interactions
FROM cust c LEFT JOIN p USING (customer_id) LEFT JOIN y USING (customer_id) LEFT JOIN l USING (customer_id)
LEFT JOIN v USING (customer_id) LEFT JOIN i USING (customer_id)""")
register("d31_segment_cascade", lambda t: t.dim_customer.select(
    "customer_id", lifecycle.customer_segment(F.lit(dt.date(2001, 6, 30))).alias("segment")
), """
SELECT customer_id, CASE WHEN price_sensitivity_score >= 0.72e0 THEN 'PRICE_SENSITIVE' WHEN digital_engagement_score >= 0.72e0 THEN 'DIGITAL_FIRST'
  WHEN household_size >= 3 AND floor(date_diff('day', birth_date, DATE '2001-06-30') / 365.25e0) BETWEEN 30 AND 58 THEN 'FAMILY_PROTECTOR'
  WHEN estimated_income_band IN ('UPPER_MID', 'HIGH') AND loyalty_score >= 0.55e0 THEN 'HIGH_VALUE' ELSE 'LOW_ENGAGEMENT' END AS segment FROM cust""")
register("d32_weighted_sampling", lambda t: lifecycle.sample_negatives(t.labels, 0.2, 0.25), """
WITH keyed AS (
  SELECT *, md5('42|' || CAST(observation_date AS VARCHAR) || '|' || customer_id) AS digest FROM lab),
drawn AS (
  SELECT *, ln((CAST(CAST('0x' || substr(digest, 1, 12) AS BIGINT) AS DOUBLE) + 1) / (power(2, 48) + 1)) / greatest(churn_probability, 0.001e0) AS key
  FROM keyed WHERE churn_label = 0),
need AS (
  SELECT split_name, CASE WHEN sum(churn_label) >= ceil(count(*) * 0.2e0) THEN 0
    ELSE least(greatest(ceil(count(*) * 0.2e0), ceil(count(*) * 0.25e0)) - sum(churn_label), count(*) - sum(churn_label)) END AS needed
  FROM lab GROUP BY split_name),
placed AS (
  SELECT d.*, row_number() OVER (PARTITION BY d.split_name ORDER BY key DESC, customer_id, observation_date) AS place FROM drawn d)
SELECT split_name, CAST(observation_date AS VARCHAR) AS observation_date, customer_id FROM placed JOIN need USING (split_name) WHERE place <= needed""")
register("d33_policy_status", lambda t: t.fact_policy.select(
    "policy_id", lifecycle.policy_status(F.lit(dt.date(2001, 6, 30))).alias("status_at_date")
), """
SELECT policy_id, CASE WHEN cancelled_on IS NOT NULL THEN 'CANCELLED' WHEN end_date >= DATE '2001-06-30' THEN 'ACTIVE' ELSE 'EXPIRED' END AS status_at_date
FROM policy""")
register("d34_instalments", lambda t: lifecycle.instalments(t.fact_policy, dt.date(2001, 6, 30)).groupBy("policy_id", "customer_id").agg(
    F.count(F.lit(1)).alias("instalments"), F.min("due_date").alias("first_due"), F.max("due_date").alias("last_due"),
    F.max("payment_amount").alias("payment_amount"),
), f"""
WITH months AS (SELECT *, CASE frequency WHEN 'MONTHLY' THEN 1 WHEN 'QUARTERLY' THEN 3 ELSE 12 END AS m,
  least(end_date, DATE '2001-06-30', coalesce(cancelled_on, end_date)) AS last_day FROM policy),
due AS (SELECT policy_id, customer_id, premium, m, unnest(generate_series(start_date, last_day, to_days(CAST(30 * m AS INTEGER)))) AS day FROM months)
SELECT policy_id, customer_id, count(*) AS instalments, CAST(CAST(min(day) AS DATE) AS VARCHAR) AS first_due,
  CAST(CAST(max(day) AS DATE) AS VARCHAR) AS last_due, max({ev('CAST(premium AS DOUBLE) * m / 12e0', 2)}) AS payment_amount
FROM due GROUP BY policy_id, customer_id""")
register("d35_policy_events", lambda t: lifecycle.policy_events(t.fact_policy).drop("product_id"), """
SELECT policy_id, customer_id, CAST(start_date AS VARCHAR) AS event_date, 'SUBSCRIPTION' AS event_type, 'NEW_BUSINESS' AS event_reason,
  CAST(NULL AS VARCHAR) AS previous_policy_status, 'ACTIVE' AS new_policy_status, CAST(NULL AS DOUBLE) AS previous_annual_premium,
  CAST(premium AS DOUBLE) AS new_annual_premium, CAST(NULL AS DOUBLE) AS premium_change_pct FROM policy
UNION ALL
SELECT policy_id, customer_id, CAST(cancelled_on AS VARCHAR), 'CANCELLATION', 'CUSTOMER_REQUEST', 'ACTIVE', 'CANCELLED',
  CAST(premium AS DOUBLE), CAST(premium AS DOUBLE), 0 FROM policy WHERE cancelled_on IS NOT NULL""")

# --- E: features ---------------------------------------------------------------------------------


def _feature(*names: str):
    return lambda t: features.engineer(t.panel).select(*KEYS, *names)


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 OR {a} IS NULL OR {b} IS NULL THEN 0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


for key, names, expressions in (
    ("e01_customer_age", ["customer_age_years"], [ev("date_diff('day', birth_date, observation_date) / 365.25e0", 2)]),
    ("e02_lifetime_days", ["customer_lifetime_days"], ["greatest(date_diff('day', acquisition_date, observation_date), 0)"]),
    ("e03_observation_parts", ["observation_year", "observation_month", "observation_quarter"],
     ["year(observation_date)", "month(observation_date)", "quarter(observation_date)"]),
    ("e04_premium_per_policy", ["premium_per_policy"], [_ratio("total_annual_premium", "active_policy_count")]),
    ("e05_amount_per_claim", ["claim_amount_per_claim_12m"], [_ratio("total_claim_amount_12m", "total_claims_12m")]),
    ("e06_incidents_per_policy", ["payment_incident_rate_per_policy"], [_ratio("payment_incidents_6m", "active_policy_count")]),
    ("e07_complaints_per_interaction", ["complaint_rate_per_interaction"], [_ratio("complaints_6m", "interactions_3m")]),
    ("e08_digital_gap", ["digital_engagement_gap"], ["digital_engagement_score - email_open_rate_6m"]),
    ("e09_value_minus_price", ["value_minus_price_sensitivity"], ["customer_value_score - price_sensitivity_score"]),
    ("e10_renewal_urgency", ["renewal_urgency_score"],
     ["coalesce(1 - CAST(CASE WHEN renewal_days_min IS NOT NULL THEN least(greatest(renewal_days_min, 0), 365) END AS DOUBLE) / 365, 0)"]),
    ("e11_renewal_window", ["renewal_window"],
     ["""CASE WHEN renewal_days_min IS NULL OR renewal_days_min <= -1 THEN 'NO_ACTIVE_POLICY' WHEN renewal_days_min <= 30 THEN '0_30_DAYS'
         WHEN renewal_days_min <= 90 THEN '31_90_DAYS' WHEN renewal_days_min <= 180 THEN '91_180_DAYS'
         WHEN renewal_days_min <= 365 THEN '181_365_DAYS' ELSE 'NO_NEAR_RENEWAL' END"""]),
    ("e12_days_to_churn", ["days_to_churn_after_observation"], ["CAST(date_diff('day', observation_date, churn_date) AS DOUBLE)"]),
    ("e13_lifecycle_default", ["customer_lifecycle_status"], ["coalesce(customer_lifecycle_status, 'ACTIVE_OBSERVED')"]),
):
    register(
        key, _feature(*names),
        f"SELECT {_KEY_SQL}, " + ", ".join(f"{e} AS {n}" for e, n in zip(expressions, names, strict=True)) + " FROM mart", 8 if "_" in key else None,
    )
    if key not in ("e03_observation_parts", "e11_renewal_window", "e12_days_to_churn", "e13_lifecycle_default", "e02_lifetime_days", "e01_customer_age"):
        register(
            key, _feature(*names),
            f"SELECT {_KEY_SQL}, " + ", ".join(f"round({e}, 8) + 0 AS {n}" for e, n in zip(expressions, names, strict=True)) + " FROM mart", 8,
        )


def _lenient(t: Tables):
    from holdfast.functions.dates import as_date
    from holdfast.functions.numeric import number

    text = t.raw("events").select(
        "event_id",
        F.when(F.col("event_id") % 29 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("amount_text"),
        F.when(F.col("event_id") % 31 == 0, F.lit("2024-13-45")).otherwise(F.to_date("ts").cast("string")).alias("day_text"),
    )
    return text.select("event_id", number("amount_text").alias("amount"), as_date("day_text").alias("day"))


register("e14_lenient_parse", _lenient, """
SELECT event_id, CASE WHEN event_id % 29 <> 0 THEN value END AS amount,
  CASE WHEN event_id % 31 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day FROM events""")
