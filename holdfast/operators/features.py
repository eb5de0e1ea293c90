"""Feature engineering: one projection per group of features, skipped where an input is absent or excluded."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.dates import as_date, years_as_decimal
from holdfast.functions.numeric import clip, number, ratio_or_zero
from holdfast.schemas import FEATURE_INPUTS

# Upper ends of the renewal windows and their labels.
RENEWAL_WINDOWS = ((30, "0_30_DAYS"), (90, "31_90_DAYS"), (180, "91_180_DAYS"), (365, "181_365_DAYS"))


def renewal_window(days: Column) -> Column:
    """Right-closed windows from day 0 on; no date, or a date further back than yesterday, has no policy."""
    chain = F.when(days.isNull() | (days <= -1), "NO_ACTIVE_POLICY")
    for upper, label in RENEWAL_WINDOWS:
        chain = chain.when(days <= upper, label)
    return chain.otherwise("NO_NEAR_RENEWAL")


def renewal_urgency(days: Column) -> Column:
    return F.coalesce(F.lit(1.0) - clip(days, 0.0, 365.0) / F.lit(365.0), F.lit(0.0))


def feature_expressions() -> dict[str, Column]:
    o = as_date("observation_date")
    return {
        "customer_age_years": years_as_decimal(o, as_date("birth_date")),
        "customer_lifetime_days": clip(F.datediff(o, as_date("acquisition_date")), low=0),
        "observation_year": F.year(o),
        "observation_month": F.month(o),
        "observation_quarter": F.quarter(o),
        "premium_per_policy": ratio_or_zero("total_annual_premium", "active_policy_count"),
        "claim_amount_per_claim_12m": ratio_or_zero("total_claim_amount_12m", "total_claims_12m"),
        "payment_incident_rate_per_policy": ratio_or_zero("payment_incidents_6m", "active_policy_count"),
        "complaint_rate_per_interaction": ratio_or_zero("complaints_6m", "interactions_3m"),
        "digital_engagement_gap": number("digital_engagement_score") - number("email_open_rate_6m"),
        "value_minus_price_sensitivity": number("customer_value_score") - number("price_sensitivity_score"),
        "renewal_urgency_score": renewal_urgency(number("renewal_days_min")),
        "renewal_window": renewal_window(number("renewal_days_min")),
    }


def engineer(df: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Add the engineered features and the two label-audit columns."""
    skipped, present = set(excluded), set(df.columns)
    added = {
        name: expression
        for name, expression in feature_expressions().items()
        if name not in skipped and set(FEATURE_INPUTS.get(name, ())) <= present
    }
    churn_date = as_date("churn_date") if "churn_date" in present else F.lit(None).cast("date")
    added["days_to_churn_after_observation"] = F.datediff(churn_date, as_date("observation_date"))
    added["customer_lifecycle_status"] = F.coalesce("customer_lifecycle_status", F.lit("ACTIVE_OBSERVED"))
    return df.withColumns(added)
