"""Declared tables and column contracts.

Fixed values: table, column and type names are the data contract every source and report shares.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

_TABLES = {
    "dim_date": """
        date_key INT, calendar_date DATE, calendar_year INT, calendar_quarter INT, calendar_month INT,
        month_name STRING, day_of_month INT, day_of_week INT, week_of_year INT, is_weekend BOOLEAN,
        is_month_end BOOLEAN, is_quarter_end BOOLEAN, is_year_end BOOLEAN""",
    "dim_geography": """
        geography_id STRING, country STRING, region STRING, department STRING, city STRING, postal_code STRING,
        urbanicity STRING, income_index DECIMAL(5,2), claim_risk_index DECIMAL(5,2),
        digital_adoption_index DECIMAL(5,2)""",
    "dim_agency": """
        agency_id STRING, agency_code STRING, agency_name STRING, geography_id STRING, agency_type STRING,
        opened_date DATE, employee_count INT""",
    "dim_channel": """
        channel_id STRING, channel_code STRING, channel_name STRING, channel_family STRING, is_digital BOOLEAN,
        is_inbound BOOLEAN""",
    "dim_agent": """
        agent_id STRING, source_agent_id STRING, agent_name STRING, agent_role STRING, channel_id STRING,
        agency_id STRING, team_name STRING, hire_date DATE""",
    "dim_product": """
        product_id STRING, product_family STRING, product_name STRING, coverage_tier STRING,
        base_annual_premium DECIMAL(12,2), deductible_amount DECIMAL(12,2), risk_level STRING,
        default_payment_frequency STRING""",
    "dim_customer": """
        customer_id STRING, source_customer_id STRING, first_name STRING, last_name STRING, birth_date DATE,
        gender STRING, email STRING, phone STRING, geography_id STRING, home_agency_id STRING,
        acquisition_date DATE, acquisition_channel_id STRING, preferred_channel_id STRING,
        employment_status STRING, household_size INT, estimated_income_band STRING, digital_profile STRING,
        consent_email BOOLEAN, consent_sms BOOLEAN, consent_phone BOOLEAN, customer_segment STRING,
        risk_affinity_score DECIMAL(6,4), price_sensitivity_score DECIMAL(6,4),
        service_sensitivity_score DECIMAL(6,4), digital_engagement_score DECIMAL(6,4),
        loyalty_score DECIMAL(6,4), claim_propensity_score DECIMAL(6,4)""",
    "fact_policy": """
        policy_id STRING, source_policy_id STRING, customer_id STRING, product_id STRING, sales_channel_id STRING,
        agent_id STRING, agency_id STRING, policy_start_date DATE, policy_end_date DATE, next_renewal_date DATE,
        policy_status STRING, payment_frequency STRING, annual_premium DECIMAL(12,2),
        premium_discount_pct DECIMAL(6,4), premium_increase_pct_last_renewal DECIMAL(6,4),
        cancellation_date DATE, cancellation_reason STRING""",
    "fact_policy_event": """
        policy_event_id STRING, policy_id STRING, customer_id STRING, product_id STRING, event_date DATE,
        event_timestamp TIMESTAMP, event_type STRING, event_reason STRING, previous_policy_status STRING,
        new_policy_status STRING, previous_annual_premium DECIMAL(12,2), new_annual_premium DECIMAL(12,2),
        premium_change_pct DECIMAL(6,4), source_system STRING""",
    "fact_payment": """
        payment_id STRING, policy_id STRING, customer_id STRING, due_date DATE, payment_date DATE,
        payment_year INT, payment_amount DECIMAL(12,2), payment_status STRING, payment_method STRING,
        days_late INT, rejection_reason STRING""",
    "fact_claim": """
        claim_id STRING, source_claim_id STRING, policy_id STRING, customer_id STRING, product_id STRING,
        claim_date DATE, reported_date DATE, closed_date DATE, claim_type STRING, claim_status STRING,
        claim_amount DECIMAL(14,2), paid_amount DECIMAL(14,2), deductible_amount DECIMAL(12,2),
        handling_days INT, fraud_suspicion_flag BOOLEAN, claim_satisfaction_score DECIMAL(4,2)""",
    "fact_interaction": """
        interaction_id STRING, customer_id STRING, policy_id STRING, channel_id STRING, agent_id STRING,
        interaction_datetime TIMESTAMP, interaction_year INT, interaction_type STRING, interaction_reason STRING,
        direction STRING, duration_seconds INT, sentiment_score DECIMAL(5,3), resolved_flag BOOLEAN""",
    "fact_customer_service": """
        case_id STRING, customer_id STRING, policy_id STRING, interaction_id STRING, opened_datetime TIMESTAMP,
        closed_datetime TIMESTAMP, case_type STRING, priority STRING, case_status STRING,
        sla_breached_flag BOOLEAN, resolution_code STRING, satisfaction_score DECIMAL(4,2)""",
    "fact_campaign_contact": """
        campaign_contact_id STRING, campaign_id STRING, customer_id STRING, policy_id STRING, channel_id STRING,
        campaign_type STRING, campaign_name STRING, contact_datetime TIMESTAMP, contact_year INT,
        opened_flag BOOLEAN, clicked_flag BOOLEAN, responded_flag BOOLEAN, converted_flag BOOLEAN,
        offer_id STRING""",
    "fact_quote": """
        quote_id STRING, customer_id STRING, product_id STRING, channel_id STRING, agent_id STRING,
        quote_date DATE, quoted_annual_premium DECIMAL(12,2), competitor_price_index DECIMAL(6,4),
        quote_status STRING, converted_policy_id STRING""",
    "fact_retention_action": """
        retention_action_id STRING, customer_id STRING, policy_id STRING, action_date DATE,
        action_timestamp TIMESTAMP, action_type STRING, trigger_reason STRING, offered_value DECIMAL(12,2),
        channel_id STRING, agent_id STRING, accepted_flag BOOLEAN, retained_90d_flag BOOLEAN""",
    "customer_360_snapshot": """
        observation_date DATE, customer_id STRING, split_name STRING, tenure_months INT, active_policy_count INT,
        number_of_products INT, total_annual_premium DECIMAL(14,2), total_claims_12m INT,
        total_claim_amount_12m DECIMAL(14,2), payment_incidents_6m INT, complaints_6m INT, interactions_3m INT,
        days_since_last_contact INT, digital_sessions_30d INT, email_open_rate_6m DECIMAL(6,4),
        premium_increase_pct_max_12m DECIMAL(6,4), avg_satisfaction_score_12m DECIMAL(4,2), renewal_days_min INT,
        customer_value_score DECIMAL(8,4), customer_age_years DECIMAL(5,2), active_auto_policy_count INT,
        active_home_policy_count INT, active_health_policy_count INT, active_life_policy_count INT,
        cancelled_policy_count_to_date INT, policy_age_avg_months DECIMAL(8,2), late_payment_count_12m INT,
        rejected_payment_count_12m INT, service_case_count_12m INT, unresolved_case_count_12m INT,
        retention_offer_count_12m INT, retention_acceptance_rate_12m DECIMAL(6,4), quote_count_6m INT,
        competitor_price_index_avg_6m DECIMAL(6,4), campaign_response_rate_6m DECIMAL(6,4),
        main_product_family STRING, highest_coverage_tier STRING, latent_churn_risk_band STRING""",
    "churn_label": """
        observation_date DATE, customer_id STRING, split_name STRING, prediction_horizon_days INT, churn_label INT,
        churn_date DATE, customer_lifecycle_status STRING, churn_probability DECIMAL(6,4),
        churn_risk_band STRING, label_reason STRING""",
    "churn_prediction": """
        observation_date DATE, customer_id STRING, split_name STRING, churn_probability DECIMAL(8,6),
        predicted_churn_label INT, churn_risk_band STRING, model_name STRING, model_version STRING,
        mlflow_run_id STRING, scored_at TIMESTAMP""",
    "generation_batch": """
        batch_id STRING, run_started_at TIMESTAMP, run_finished_at TIMESTAMP, generation_mode STRING, seed INT,
        n_customers INT, history_start_date DATE, history_end_date DATE, status STRING, error_message STRING,
        created_by STRING""",
    "retention_priority_queue": """
        observation_date DATE, customer_id STRING, split_name STRING, first_name STRING, last_name STRING,
        customer_segment STRING, region STRING, agency_name STRING, main_product_family STRING,
        churn_probability DECIMAL(8,6), churn_risk_band STRING, estimated_annual_value DECIMAL(12,2),
        retention_propensity DECIMAL(8,4), expected_saved_value DECIMAL(12,2), priority_score DECIMAL(8,2),
        priority_tier STRING, recommended_action_type STRING, recommended_channel STRING,
        estimated_offer_value DECIMAL(12,2), action_reason STRING, business_context STRING, model_name STRING,
        model_version STRING, mlflow_run_id STRING, scored_at TIMESTAMP, queued_at TIMESTAMP""",
    "retention_recommendation": """
        recommendation_id STRING, observation_date DATE, customer_id STRING, split_name STRING, first_name STRING,
        last_name STRING, priority_tier STRING, priority_score DECIMAL(8,2), churn_probability DECIMAL(8,6),
        expected_saved_value DECIMAL(12,2), recommended_action_type STRING, recommended_channel STRING,
        recommended_offer STRING, estimated_offer_value DECIMAL(12,2), advisor_message STRING,
        decision_rationale STRING, next_best_step STRING, human_review_status STRING, approval_decision STRING,
        approval_comment STRING, mlflow_run_id STRING, created_at TIMESTAMP""",
}


_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """A struct from ``name TYPE`` pairs; unlike ``fromDDL`` it needs no running session."""
    fields = []
    for part in re.split(r",(?![^(]*\))", columns):
        name, kind = part.split()
        if kind.startswith("DECIMAL"):
            precision, scale = kind[8:-1].split(",")
            fields.append(T.StructField(name, T.DecimalType(int(precision), int(scale))))
        else:
            fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


def table_schema(name: str) -> T.StructType:
    return _struct(_TABLES[name])


TABLE_NAMES = tuple(_TABLES)

# Report files that jobs write and later steps read back.
DRIFT_REPORT_SCHEMA = _struct(
    "reference_split STRING, comparison_split STRING, feature STRING, feature_type STRING, psi DOUBLE, "
    "secondary_metric_name STRING, secondary_metric DOUBLE, secondary_pvalue DOUBLE, "
    "reference_missing_rate DOUBLE, comparison_missing_rate DOUBLE, missing_rate_delta DOUBLE, "
    "reference_mean DOUBLE, comparison_mean DOUBLE, reference_top_value STRING, comparison_top_value STRING, "
    "severity STRING, severity_rank INT, is_reference_comparison BOOLEAN"
)
SHAP_SUMMARY_SCHEMA = _struct(
    "rank INT, feature STRING, feature_type STRING, mean_abs_shap DOUBLE, mean_shap DOUBLE, "
    "positive_impact_share DOUBLE, normalized_importance_pct DOUBLE, impact_direction STRING"
)


# The model's column contract.
ENGINEERED_NUMERIC = (
    "customer_age_years", "customer_lifetime_days", "observation_year", "observation_month",
    "observation_quarter", "premium_per_policy", "claim_amount_per_claim_12m",
    "payment_incident_rate_per_policy", "complaint_rate_per_interaction", "digital_engagement_gap",
    "value_minus_price_sensitivity", "renewal_urgency_score",
)
ENGINEERED_CATEGORICAL = ("renewal_window",)
NUMERIC_FEATURES = (
    "tenure_months", "active_policy_count", "number_of_products", "total_annual_premium", "total_claims_12m",
    "total_claim_amount_12m", "payment_incidents_6m", "complaints_6m", "interactions_3m",
    "days_since_last_contact", "digital_sessions_30d", "email_open_rate_6m", "premium_increase_pct_max_12m",
    "avg_satisfaction_score_12m", "renewal_days_min", "customer_value_score", "price_sensitivity_score",
    "service_sensitivity_score", "digital_engagement_score", "loyalty_score", "claim_propensity_score",
    "active_auto_policy_count", "active_home_policy_count", "active_health_policy_count",
    "active_life_policy_count", "cancelled_policy_count_to_date", "policy_age_avg_months",
    "late_payment_count_12m", "rejected_payment_count_12m", "service_case_count_12m",
    "unresolved_case_count_12m", "retention_offer_count_12m", "retention_acceptance_rate_12m",
    "quote_count_6m", "competitor_price_index_avg_6m", "campaign_response_rate_6m",
) + ENGINEERED_NUMERIC
CATEGORICAL_FEATURES = (
    "latent_churn_risk_band", "customer_segment", "estimated_income_band", "digital_profile", "agency_type",
    "region", "urbanicity", "main_product_family", "highest_coverage_tier",
) + ENGINEERED_CATEGORICAL
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
TARGET_COLUMN = "churn_label"
ID_COLUMNS = ("observation_date", "customer_id")
SPLIT_COLUMN = "split_name"
SPLIT_ORDER = ("train", "validation", "test", "backtest")
REPORT_SPLIT_ORDER = ("train", "validation", "backtest", "test")
ALWAYS_EXCLUDED = ("latent_churn_risk_band",)
LABEL_ONLY_COLUMNS = (
    "churn_date", "customer_lifecycle_status", "days_to_churn_after_observation", "synthetic_churn_probability",
    "churn_risk_band", "label_reason",
)
PROTECTED_COLUMNS = ID_COLUMNS + (SPLIT_COLUMN, TARGET_COLUMN, "birth_date", "acquisition_date") + LABEL_ONLY_COLUMNS
FEATURE_INPUTS = {
    "customer_age_years": ("birth_date",),
    "customer_lifetime_days": ("acquisition_date",),
    "premium_per_policy": ("total_annual_premium", "active_policy_count"),
    "claim_amount_per_claim_12m": ("total_claim_amount_12m", "total_claims_12m"),
    "payment_incident_rate_per_policy": ("payment_incidents_6m", "active_policy_count"),
    "complaint_rate_per_interaction": ("complaints_6m", "interactions_3m"),
    "digital_engagement_gap": ("digital_engagement_score", "email_open_rate_6m"),
    "value_minus_price_sensitivity": ("customer_value_score", "price_sensitivity_score"),
    "renewal_urgency_score": ("renewal_days_min",),
    "renewal_window": ("renewal_days_min",),
}


@dataclass(frozen=True)
class TableRules:
    """Integrity rules of one table, checked by ``holdfast.operators.quality``."""

    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    nullable: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()
    domains: dict[str, tuple] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)


_SPLITS = ("train", "validation", "test", "backtest")
_BANDS = ("LOW", "MEDIUM", "HIGH", "VERY_HIGH")
_FREQUENCIES = ("MONTHLY", "QUARTERLY", "ANNUAL")
_CUSTOMER_FK = ("customer_id", "dim_customer", "customer_id")
_POLICY_FK = ("policy_id", "fact_policy", "policy_id")
_CHANNEL_FK = ("channel_id", "dim_channel", "channel_id")
_AGENT_FK = ("agent_id", "dim_agent", "agent_id")
_PRODUCT_FK = ("product_id", "dim_product", "product_id")

# Keys, enumerations and checks every loaded table must satisfy.
TABLE_RULES = {
    "dim_date": TableRules(("date_key",), (("calendar_date",),)),
    "dim_geography": TableRules(("geography_id",), domains={"urbanicity": ("URBAN", "SUBURBAN", "RURAL")}),
    "dim_agency": TableRules(
        ("agency_id",), (("agency_code",),),
        foreign_keys=(("geography_id", "dim_geography", "geography_id"),),
        domains={"agency_type": ("BRANCH", "CALL_CENTER", "BROKER_HUB", "RETENTION_CENTER")},
        checks={"employee_count_positive": "employee_count > 0"},
    ),
    "dim_channel": TableRules(
        ("channel_id",), (("channel_code",),),
        domains={"channel_family": ("DIGITAL", "HUMAN", "PARTNER", "OUTBOUND")},
    ),
    "dim_agent": TableRules(
        ("agent_id",), (("source_agent_id",),),
        foreign_keys=(_CHANNEL_FK, ("agency_id", "dim_agency", "agency_id")),
        domains={"agent_role": ("SALES", "SERVICE", "CLAIMS", "RETENTION", "HYBRID")},
    ),
    "dim_product": TableRules(
        ("product_id",),
        domains={
            "product_family": ("AUTO", "HOME", "HEALTH", "LIFE", "TRAVEL", "PET", "PERSONAL_ACCIDENT"),
            "coverage_tier": ("BASIC", "STANDARD", "PREMIUM"),
            "risk_level": _BANDS,
            "default_payment_frequency": _FREQUENCIES,
        },
    ),
    "dim_customer": TableRules(
        ("customer_id",), (("source_customer_id",), ("email",)), ("phone",),
        foreign_keys=(
            ("geography_id", "dim_geography", "geography_id"),
            ("home_agency_id", "dim_agency", "agency_id"),
            ("acquisition_channel_id", "dim_channel", "channel_id"),
            ("preferred_channel_id", "dim_channel", "channel_id"),
        ),
        domains={
            "gender": ("F", "M", "OTHER"),
            "estimated_income_band": ("LOW", "LOWER_MID", "MID", "UPPER_MID", "HIGH"),
            "digital_profile": ("LOW", "MEDIUM", "HIGH"),
            "customer_segment": ("PRICE_SENSITIVE", "DIGITAL_FIRST", "FAMILY_PROTECTOR", "HIGH_VALUE", "LOW_ENGAGEMENT"),
        },
        checks={"household_size_range": "household_size BETWEEN 1 AND 7"},
    ),
    "fact_policy": TableRules(
        ("policy_id",), (("source_policy_id",),),
        ("agent_id", "next_renewal_date", "cancellation_date", "cancellation_reason"),
        foreign_keys=(
            _CUSTOMER_FK, _PRODUCT_FK, ("sales_channel_id", "dim_channel", "channel_id"), _AGENT_FK,
            ("agency_id", "dim_agency", "agency_id"),
        ),
        domains={"policy_status": ("ACTIVE", "LAPSED", "CANCELLED", "EXPIRED"), "payment_frequency": _FREQUENCIES},
        checks={
            "cancellation_consistency":
                "(policy_status IN ('CANCELLED', 'LAPSED')) = (cancellation_date IS NOT NULL)",
        },
    ),
    "fact_policy_event": TableRules(
        ("policy_event_id",),
        nullable=(
            "event_reason", "previous_policy_status", "new_policy_status", "previous_annual_premium",
            "new_annual_premium", "premium_change_pct",
        ),
        foreign_keys=(_POLICY_FK, _CUSTOMER_FK, _PRODUCT_FK),
        domains={"event_type": ("SUBSCRIPTION", "RENEWAL", "PREMIUM_CHANGE", "ENDORSEMENT", "CANCELLATION", "REINSTATEMENT")},
    ),
    "fact_payment": TableRules(
        ("payment_id",), nullable=("payment_date", "rejection_reason"),
        foreign_keys=(_POLICY_FK, _CUSTOMER_FK),
        domains={
            "payment_status": ("PAID", "LATE", "REJECTED", "REFUNDED", "WRITTEN_OFF"),
            "payment_method": ("CARD", "DIRECT_DEBIT", "BANK_TRANSFER", "CHECK", "CASH", "WALLET"),
        },
    ),
    "fact_claim": TableRules(
        ("claim_id",), (("source_claim_id",),), ("closed_date", "handling_days", "claim_satisfaction_score"),
        foreign_keys=(_POLICY_FK, _CUSTOMER_FK, _PRODUCT_FK),
        domains={"claim_status": ("OPEN", "UNDER_REVIEW", "APPROVED", "REJECTED", "CLOSED")},
    ),
    "fact_interaction": TableRules(
        ("interaction_id",), nullable=("policy_id", "agent_id"),
        foreign_keys=(_CUSTOMER_FK, _POLICY_FK, _CHANNEL_FK, _AGENT_FK),
        domains={"direction": ("INBOUND", "OUTBOUND")},
    ),
    "fact_customer_service": TableRules(
        ("case_id",),
        nullable=("policy_id", "interaction_id", "closed_datetime", "resolution_code", "satisfaction_score"),
        foreign_keys=(_CUSTOMER_FK, _POLICY_FK, ("interaction_id", "fact_interaction", "interaction_id")),
        domains={
            "case_type": ("REQUEST", "COMPLAINT", "CLAIM_SUPPORT", "BILLING", "CANCELLATION_INTENT"),
            "priority": ("LOW", "MEDIUM", "HIGH", "CRITICAL"),
            "case_status": ("OPEN", "IN_PROGRESS", "RESOLVED", "ESCALATED", "CLOSED"),
        },
    ),
    "fact_campaign_contact": TableRules(
        ("campaign_contact_id",), nullable=("policy_id", "offer_id"),
        foreign_keys=(_CUSTOMER_FK, _POLICY_FK, _CHANNEL_FK),
        domains={"campaign_type": ("ACQUISITION", "CROSS_SELL", "UPSELL", "RENEWAL", "WINBACK", "RETENTION")},
    ),
    "fact_quote": TableRules(
        ("quote_id",), nullable=("agent_id", "converted_policy_id"),
        foreign_keys=(
            _CUSTOMER_FK, _PRODUCT_FK, _CHANNEL_FK, _AGENT_FK,
            ("converted_policy_id", "fact_policy", "policy_id"),
        ),
        domains={"quote_status": ("CREATED", "SENT", "ACCEPTED", "DECLINED", "EXPIRED")},
    ),
    "fact_retention_action": TableRules(
        ("retention_action_id",), nullable=("policy_id", "agent_id"),
        foreign_keys=(_CUSTOMER_FK, _POLICY_FK, _CHANNEL_FK, _AGENT_FK),
        domains={
            "action_type": ("DISCOUNT", "COVERAGE_UPGRADE", "CALLBACK", "PAYMENT_PLAN", "LOYALTY_BONUS", "CLAIM_REVIEW"),
            "trigger_reason": (
                "PREMIUM_INCREASE", "COMPLAINT", "PAYMENT_INCIDENT", "LOW_ENGAGEMENT", "RENEWAL_RISK", "HIGH_VALUE_SAVE",
            ),
        },
    ),
    "customer_360_snapshot": TableRules(
        ID_COLUMNS, nullable=("avg_satisfaction_score_12m", "renewal_days_min"), foreign_keys=(_CUSTOMER_FK,),
        domains={"split_name": _SPLITS, "latent_churn_risk_band": _BANDS},
    ),
    "churn_label": TableRules(
        ID_COLUMNS, nullable=("churn_date",), foreign_keys=(_CUSTOMER_FK,),
        domains={
            "split_name": _SPLITS, "churn_label": (0, 1), "churn_risk_band": _BANDS,
            "customer_lifecycle_status": ("ACTIVE_OBSERVED", "CHURNED_WITHIN_HORIZON"),
        },
        checks={
            "churn_label_date_consistency":
                "(churn_label = 1) = (churn_date IS NOT NULL) AND "
                "(churn_label = 1) = (customer_lifecycle_status = 'CHURNED_WITHIN_HORIZON')",
        },
    ),
    "churn_prediction": TableRules(
        ID_COLUMNS + ("model_name", "mlflow_run_id"), nullable=("model_version",), foreign_keys=(_CUSTOMER_FK,),
        domains={
            "split_name": ("validation", "test", "backtest", "scoring"), "predicted_churn_label": (0, 1),
            "churn_risk_band": _BANDS,
        },
    ),
    "generation_batch": TableRules(
        ("batch_id",), nullable=("run_finished_at", "error_message"),
        domains={"generation_mode": ("reset", "incremental"), "status": ("STARTED", "SUCCEEDED", "FAILED")},
    ),
    "retention_priority_queue": TableRules(ID_COLUMNS + ("mlflow_run_id",), nullable=("model_version",)),
    "retention_recommendation": TableRules(
        ("recommendation_id",), nullable=("approval_decision", "approval_comment"),
    ),
}
