"""Retention priority scoring: one projection over the candidate mart plus one distributed rank."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import band, clip, even_round, fixed_text, number, number_or
from holdfast.operators.prefix import average_percent_rank


@dataclass(frozen=True)
class PriorityWeights:
    """Weights, cuts and caps of the priority rules."""

    probability: float = 0.42
    value: float = 0.24
    propensity: float = 0.16
    urgency: float = 0.12
    business: float = 0.06
    scale: float = 100.0
    tiers: tuple[tuple[float, str], ...] = ((65.0, "CRITICAL"), (50.0, "HIGH"), (35.0, "MEDIUM"))
    offers: tuple[tuple[str, float, float], ...] = (
        ("CRITICAL", 0.12, 300.0), ("HIGH", 0.08, 180.0), ("MEDIUM", 0.05, 90.0), ("LOW", 0.03, 40.0),
    )


QUEUE_COLUMNS = (
    "observation_date", "customer_id", "split_name", "first_name", "last_name", "customer_segment", "region",
    "agency_name", "main_product_family", "churn_probability", "churn_risk_band", "estimated_annual_value",
    "retention_propensity", "expected_saved_value", "priority_score", "priority_tier", "recommended_action_type",
    "recommended_channel", "estimated_offer_value", "action_reason", "business_context", "model_name",
    "model_version", "mlflow_run_id", "scored_at",
)
# Reasons in their order of precedence, and the sentence when none applies.
DEFAULT_REASON = "high churn risk and significant customer value"


def propensity() -> Column:
    """Likelihood to accept a retention action."""
    # Base and weights.
    return clip(
        F.lit(0.18)
        + F.lit(0.28) * number_or("loyalty_score", 0.4)
        + F.lit(0.22) * number_or("retention_acceptance_rate_12m", 0.0)
        + F.lit(0.16) * number_or("campaign_response_rate_6m", 0.0)
        - F.lit(0.06) * number_or("price_sensitivity_score", 0.5)
        - F.lit(0.025) * F.least(number_or("service_case_count_12m", 0.0), F.lit(6.0))
        - F.lit(0.04) * F.least(number_or("unresolved_case_count_12m", 0.0), F.lit(4.0)),
        0.05, 0.9,
    )


def urgency() -> Column:
    days = number("renewal_days_min")
    # Cuts in days and their urgency.
    return F.when(days <= 15, 1.0).when(days <= 45, 0.75).when(days <= 90, 0.45).otherwise(0.2)


def business_score() -> Column:
    extra = (
        F.when(F.col("customer_segment") == "HIGH_VALUE", 0.35).when(F.col("customer_segment") == "FAMILY_PROTECTOR", 0.2).otherwise(0.0)
    )
    tier = F.when(F.col("highest_coverage_tier") == "PREMIUM", 0.15).otherwise(0.0)
    return F.least(F.lit(0.35) + extra + tier, F.lit(1.0))


def with_value_score(candidates: DataFrame) -> DataFrame:
    """Add ``value_score``: the larger of the premium's percentile rank over all candidates and the clipped customer value."""
    rows = candidates.withColumn("_annual", number_or("total_annual_premium", 0.0))
    ranked = average_percent_rank(rows, "_annual", "_rank", ["observation_date", "customer_id"])
    value = F.greatest(F.col("_rank"), clip(number_or("customer_value_score", 0.0), 0.0, 1.0))
    return ranked.withColumn("value_score", value).drop("_annual", "_rank")


def tier(score: Column, w: PriorityWeights = PriorityWeights()) -> Column:
    return band(score, w.tiers, "LOW")


def _at_least(column: str, cut: float) -> Column:
    return F.coalesce(number(column) >= cut, F.lit(False))


def _signals() -> dict[str, Column]:
    return {
        "increase": _at_least("premium_increase_pct_max_12m", 0.1),
        "competitor": F.coalesce(number("competitor_price_index_avg_6m") < 0.95, F.lit(False)),
        "complaints": _at_least("complaints_6m", 2),
        "unresolved": _at_least("unresolved_case_count_12m", 1),
        "renewal": F.coalesce(number("renewal_days_min") <= 45, F.lit(False)),
        "payment": _at_least("payment_incidents_6m", 1),
        "rejected": _at_least("rejected_payment_count_12m", 1),
        "offline": F.coalesce(number("digital_sessions_30d") <= 1, F.lit(False)),
        "opens": _at_least("email_open_rate_6m", 0.25),
    }


def action_type() -> Column:
    """First action whose trigger holds; a missing value never triggers."""
    s = _signals()
    return (
        F.when(s["increase"] | s["competitor"], "LOYALTY_DISCOUNT_REVIEW")
        .when(s["complaints"] | s["unresolved"], "SERVICE_RECOVERY_CALL")
        .when(s["renewal"], "RENEWAL_SAVE_CALL")
        .when(s["payment"] | s["rejected"], "PAYMENT_PLAN_PROPOSAL")
        .when(s["offline"] & s["opens"], "DIGITAL_REENGAGEMENT")
        .otherwise("PROACTIVE_RETENTION_CHECK")
    )


def channel(match_codes: bool = False) -> Column:
    """Preferred channel if consented, else the first consent.

    The rule names channel ids (``CH_PHONE``) while the mart carries channel codes (``EMAIL``), so on loaded
    data only the consent fallback applies. ``match_codes`` also accepts the codes.
    """
    preferred = F.col("preferred_channel_code")
    if match_codes:
        preferred = F.when(preferred.startswith("CH_"), preferred).otherwise(F.concat(F.lit("CH_"), preferred))
    phone, email, sms = (F.coalesce(F.col(c), F.lit(False)) for c in ("consent_phone", "consent_email", "consent_sms"))
    return (
        F.when(preferred.isin("CH_PHONE", "CH_AGENCY", "CH_RETENTION_OUTBOUND") & phone, "PHONE")
        .when(preferred.isin("CH_EMAIL", "CH_WEB", "CH_MOBILE") & email, "EMAIL")
        .when((preferred == "CH_SMS") & sms, "SMS")
        .when(phone, "PHONE").when(email, "EMAIL").when(sms, "SMS").otherwise("AGENCY_TASK")
    )


def offer_value(tier_column: Column, annual_value: Column, w: PriorityWeights = PriorityWeights()) -> Column:
    chain = F.when(F.lit(False), F.lit(0.0))
    for name, share, cap in w.offers[:-1]:
        chain = chain.when(tier_column == name, F.least(annual_value * F.lit(share), F.lit(cap)))
    _, share, cap = w.offers[-1]
    return even_round(chain.otherwise(F.least(annual_value * F.lit(share), F.lit(cap))), 2)


def action_reason() -> Column:
    """Up to four triggered reasons in order."""
    s = _signals()
    reasons = F.array(
        F.when(s["increase"], "recent premium increase"),
        F.when(s["competitor"], "competitor price pressure"),
        F.when(s["complaints"], "recent complaints"),
        F.when(s["unresolved"], "unresolved service case"),
        F.when(s["renewal"], "upcoming renewal"),
        F.when(s["payment"], "payment incident"),
        F.when(s["offline"], "low digital engagement"),
    )
    text = F.array_join(F.slice(F.array_compact(reasons), 1, 4), "; ")
    return F.when(text == "", DEFAULT_REASON).otherwise(text)


def money_text(c: Column | str) -> Column:
    """Two digits after half-even rounding of the double, so that text and number agree."""
    return fixed_text(c, 2)


def business_context() -> Column:
    return F.concat_ws(
        " | ", "customer_segment", "main_product_family", "region",
        F.concat(F.lit("estimated annual value "), money_text("estimated_annual_value"), F.lit(" EUR")),
    )


def score(candidates: DataFrame, w: PriorityWeights = PriorityWeights(), match_codes: bool = False) -> DataFrame:
    """The unordered queue with every scoring column."""
    p, annual = number_or("churn_probability", 0.0), number_or("total_annual_premium", 0.0)
    rows = with_value_score(candidates).withColumn("_propensity", propensity())
    raw = (
        F.lit(w.probability) * p + F.lit(w.value) * F.col("value_score") + F.lit(w.propensity) * F.col("_propensity")
        + F.lit(w.urgency) * urgency() + F.lit(w.business) * business_score()
    )
    yearly = annual * (F.lit(1.0) + F.lit(0.04) * F.greatest(number_or("active_policy_count", 0.0), F.lit(0.0)))
    scored = rows.withColumns({
        "estimated_annual_value": even_round(yearly, 2),
        "retention_propensity": even_round("_propensity", 4),
        "priority_score": even_round(F.lit(w.scale) * raw, 2),
        "expected_saved_value": even_round(yearly * p * F.col("_propensity"), 2),
        "recommended_action_type": action_type(),
        "recommended_channel": channel(match_codes),
        "action_reason": action_reason(),
    })
    graded = scored.withColumn("priority_tier", tier(F.col("priority_score"), w))
    finished = graded.withColumns({
        "estimated_offer_value": offer_value(F.col("priority_tier"), F.col("estimated_annual_value"), w),
        "business_context": business_context(),
    })
    return finished.select(*QUEUE_COLUMNS)


def ordered_queue(queue: DataFrame, top_n: int | None = None) -> DataFrame:
    """Best score first; ``top_n`` keeps a bounded heap per task. Ties end on the customer id."""
    ranked = queue.orderBy(
        F.desc("priority_score"), F.desc("expected_saved_value"), F.desc("churn_probability"), "customer_id", "observation_date"
    )
    return ranked if top_n is None else ranked.limit(top_n)
