"""Joins that build the analytical marts.

Dimension joins carry no broadcast hint: table statistics and adaptive execution choose broadcast only
under the session's size threshold and fall back to shuffled joins beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.schemas import ID_COLUMNS

_SNAPSHOT_ONLY = (
    "tenure_months", "active_policy_count", "number_of_products", "total_annual_premium", "total_claims_12m",
    "total_claim_amount_12m", "payment_incidents_6m", "complaints_6m", "interactions_3m", "days_since_last_contact",
    "digital_sessions_30d", "email_open_rate_6m", "premium_increase_pct_max_12m", "avg_satisfaction_score_12m",
    "renewal_days_min", "customer_value_score", "late_payment_count_12m", "rejected_payment_count_12m",
    "service_case_count_12m", "unresolved_case_count_12m", "retention_offer_count_12m",
    "retention_acceptance_rate_12m", "quote_count_6m", "competitor_price_index_avg_6m",
    "campaign_response_rate_6m", "main_product_family", "highest_coverage_tier",
)


def training_mart(snapshot: DataFrame, label: DataFrame, customer: DataFrame, agency: DataFrame, geography: DataFrame) -> DataFrame:
    """Snapshot with its label, customer, agency and geography, all inner."""
    labels = label.select(
        *ID_COLUMNS, "churn_label", "churn_date", "customer_lifecycle_status",
        F.col("churn_probability").alias("synthetic_churn_probability"), "churn_risk_band", "label_reason",
    )
    people = customer.select(
        "customer_id", "birth_date", "acquisition_date", "customer_segment", "estimated_income_band",
        "digital_profile", "price_sensitivity_score", "service_sensitivity_score", "digital_engagement_score",
        "loyalty_score", "claim_propensity_score", F.col("home_agency_id").alias("agency_id"), "geography_id",
    )
    return (
        snapshot.withColumnRenamed("customer_age_years", "snapshot_customer_age_years")
        .join(labels, list(ID_COLUMNS))
        .join(people, "customer_id")
        .join(agency.select("agency_id", "agency_type"), "agency_id")
        .join(geography.select("geography_id", "region", "urbanicity"), "geography_id")
        .drop("agency_id", "geography_id")
    )


def latest_run(predictions: DataFrame) -> DataFrame:
    """One row: the run with the latest score time; equal times go to the larger run id."""
    return predictions.agg(
        F.max(F.struct("scored_at", "mlflow_run_id")).alias("_last")
    ).select(F.col("_last.mlflow_run_id").alias("mlflow_run_id"), F.col("_last.scored_at").alias("scored_at"))


def of_latest_run(predictions: DataFrame) -> DataFrame:
    """Predictions of the latest run; the run id is a scalar subquery, so a table partitioned by run, as ``upsert_predictions``
    writes it, is pruned to that run's folders when the query starts."""
    run = latest_run(predictions).select("mlflow_run_id").scalar()
    return predictions.filter(F.col("mlflow_run_id") == run)


def customer_context(customer: DataFrame, channel: DataFrame, agency: DataFrame, geography: DataFrame) -> DataFrame:
    """The customer columns that the retention queue shows and scores."""
    return (
        customer.join(channel.select(
            F.col("channel_id").alias("preferred_channel_id"), F.col("channel_code").alias("preferred_channel_code"),
            F.col("channel_name").alias("preferred_channel_name"),
        ), "preferred_channel_id")
        .join(agency.select(F.col("agency_id").alias("home_agency_id"), "agency_name", "agency_type"), "home_agency_id")
        .join(geography.select("geography_id", "region", "urbanicity"), "geography_id")
        .select(
            "customer_id", "first_name", "last_name", "customer_segment", "estimated_income_band", "digital_profile",
            "price_sensitivity_score", "service_sensitivity_score", "digital_engagement_score", "loyalty_score",
            "claim_propensity_score", "consent_email", "consent_sms", "consent_phone", "preferred_channel_code",
            "preferred_channel_name", "agency_name", "agency_type", "region", "urbanicity",
        )
    )


def candidate_mart(
    predictions: DataFrame, snapshot: DataFrame, customer: DataFrame, channel: DataFrame, agency: DataFrame,
    geography: DataFrame, splits: Sequence[str] = ("test", "backtest"),
) -> DataFrame:
    """Retention candidates: latest-run predictions of the given splits with snapshot and customer context."""
    chosen = of_latest_run(predictions).filter(F.col("split_name").isin(*splits))
    facts = snapshot.filter(F.col("split_name").isin(*splits)).select(*ID_COLUMNS, *_SNAPSHOT_ONLY)
    return chosen.join(facts, list(ID_COLUMNS)).join(customer_context(customer, channel, agency, geography), "customer_id")


def customer_profiles(
    customer: DataFrame, agency: DataFrame, geography: DataFrame, snapshot: DataFrame, predictions: DataFrame,
    queue: DataFrame, recommendations: DataFrame, run_id: str | None = None,
) -> DataFrame:
    """Every profile row of every customer; without ``run_id`` each prediction run gives its own row."""
    scores = predictions if run_id is None else predictions.filter(F.col("mlflow_run_id") == run_id)
    run_key = [*ID_COLUMNS, "mlflow_run_id"]
    base = (
        customer.join(agency.select(F.col("agency_id").alias("home_agency_id"), "agency_name"), "home_agency_id")
        .join(geography.select("geography_id", "region"), "geography_id")
        .select(
            "customer_id", "first_name", "last_name", "customer_segment", "estimated_income_band", "digital_profile",
            "price_sensitivity_score", "service_sensitivity_score", "loyalty_score", "consent_email", "consent_sms",
            "consent_phone", "agency_name", "region",
        )
    )
    return (
        base.join(snapshot.select(
            "customer_id", "observation_date", "tenure_months", "active_policy_count", "number_of_products",
            "total_annual_premium", "payment_incidents_6m", "complaints_6m", "days_since_last_contact",
            "avg_satisfaction_score_12m", "renewal_days_min",
        ), "customer_id", "left")
        .join(scores.select(*run_key, "churn_probability", "churn_risk_band", "predicted_churn_label"), list(ID_COLUMNS), "left")
        .join(queue.select(
            *run_key, "priority_tier", "priority_score", "recommended_action_type", "recommended_channel", "action_reason",
        ), run_key, "left")
        .join(recommendations.select(*run_key, "recommended_offer", "advisor_message", "next_best_step"), run_key, "left")
    )


def profile_of(profiles: DataFrame, customer_id: str, limit: int = 1) -> DataFrame:
    """One customer's rows, latest observation first, unseen last."""
    return (
        profiles.filter(F.col("customer_id") == customer_id)
        .orderBy(F.desc_nulls_last("observation_date"), F.desc_nulls_last("mlflow_run_id")).limit(limit)
    )


def latest_per_customer(profiles: DataFrame) -> DataFrame:
    """The newest row of every customer; the row limit per group is pushed below the shuffle."""
    newest = Window.partitionBy("customer_id").orderBy(
        F.desc_nulls_last("observation_date"), F.desc_nulls_last("mlflow_run_id")
    )
    return profiles.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def customers_in(
    customer: DataFrame, agency: DataFrame, geography: DataFrame, *, city: str | None = None, region: str | None = None
) -> DataFrame:
    """Customers of a city or region, letter case ignored, ordered by id."""
    places = geography.select("geography_id", "city", "region")
    for column, wanted in (("city", city), ("region", region)):
        if wanted is not None:
            places = places.filter(F.lower(column) == F.lower(F.lit(wanted)))
            break
    return (
        customer.join(agency.select(F.col("agency_id").alias("home_agency_id"), "agency_name"), "home_agency_id")
        .join(places, "geography_id")
        .select("customer_id", "first_name", "last_name", "customer_segment", "digital_profile", "agency_name", "city", "region")
        .orderBy("customer_id")
    )


def queue_with_recommendations(queue: DataFrame, recommendations: DataFrame) -> DataFrame:
    reviewed = recommendations.select(*ID_COLUMNS, "mlflow_run_id", "recommendation_id", "human_review_status")
    return queue.join(reviewed, [*ID_COLUMNS, "mlflow_run_id"], "left")


def with_default(rows: DataFrame, catalog: DataFrame, key: str, default_key: str) -> DataFrame:
    """Left-join a static catalog; keys it lacks take the default entry. The catalog is literal rows in the plan."""
    values = [c for c in catalog.columns if c != key]
    fallback = catalog.filter(F.col(key) == default_key).select(F.struct(*values)).scalar()
    joined = rows.join(catalog.withColumn("_hit", F.lit(True)), key, "left").withColumn("_default", fallback)
    return joined.select(
        *rows.columns,
        *[F.when(F.col("_hit"), F.col(v)).otherwise(F.col(f"_default.{v}")).alias(v) for v in values],
    )


def product_tiers(policies: DataFrame, products: DataFrame) -> DataFrame:
    """Policies with their product's tier; policies of unknown products are left out."""
    return policies.join(products.select("product_id", "coverage_tier"), "product_id")


def rows_of_features(report: DataFrame, features: DataFrame) -> DataFrame:
    """Report rows whose feature is in the given set."""
    return report.join(features.select("feature"), "feature", "left_semi")


def agencies_by_customers(customer: DataFrame, agency: DataFrame, geography: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` agencies with the most customers. Customers are counted per agency before any join."""
    counted = customer.groupBy(F.col("home_agency_id").alias("agency_id")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.join(agency, "agency_id").join(geography.select("geography_id", "region"), "geography_id")
        .groupBy("agency_name", "region").agg(F.sum("_n").alias("customers"))
        .orderBy(F.desc("customers"), "agency_name", "region").limit(limit)
    )


def contacts_this_week(recommendations: DataFrame, customer: DataFrame, agency: DataFrame, as_of: Column) -> DataFrame:
    """Recommendations created since Monday per agency, with the approved share."""
    from holdfast.functions.dates import week_start

    fresh = recommendations.filter(F.col("created_at") >= week_start(as_of))
    approved = F.when(F.col("human_review_status") == "APPROVED", 1).otherwise(0)
    return (
        fresh.join(customer.select("customer_id", F.col("home_agency_id").alias("agency_id")), "customer_id")
        .groupBy("agency_id").agg(F.count(F.lit(1)).alias("_n"), F.sum(approved).alias("_approved"))
        .join(agency.select("agency_id", "agency_name"), "agency_id")
        .groupBy("agency_name").agg(
            F.sum("_n").alias("contacted_customers"), (F.sum("_approved") / F.sum("_n")).alias("approved_action_rate"),
        )
        .orderBy(F.desc("contacted_customers"), "agency_name")
    )
