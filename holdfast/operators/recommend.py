"""Reviewable recommendations and contact drafts from the retention queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.numeric import fixed_text
from holdfast.operators.marts import with_default
from holdfast.operators.priority import money_text

DEFAULT_ACTION = "PROACTIVE_RETENTION_CHECK"
# Fixed values: (action, offer, advisor message, next step) of each strategy.
STRATEGIES = (
    (
        "LOYALTY_DISCOUNT_REVIEW", "Controlled loyalty discount",
        "Contact the customer to acknowledge price sensitivity and propose a loyalty discount aligned with portfolio value.",
        "Retention manager approval before commercial proposal.",
    ),
    (
        "SERVICE_RECOVERY_CALL", "Priority resolution call",
        "Call the customer to address service pain points, clarify the open case, and confirm a corrective action.",
        "Assign a senior service advisor within 24 hours.",
    ),
    (
        "RENEWAL_SAVE_CALL", "Renewal save call",
        "Contact the customer before renewal to explain coverage value and propose an adjustment if needed.",
        "Schedule an outbound call before the next renewal date.",
    ),
    (
        "PAYMENT_PLAN_PROPOSAL", "Payment plan adjustment",
        "Offer a more flexible payment solution to reduce churn risk linked to payment incidents.",
        "Check eligibility for split payment.",
    ),
    (
        "DIGITAL_REENGAGEMENT", "Assisted digital reactivation",
        "Send a digital re-engagement sequence with reminders about useful services and offer an appointment if needed.",
        "Trigger a personalized email campaign.",
    ),
    (
        "PROACTIVE_RETENTION_CHECK", "Proactive retention check",
        "Review the customer's situation and propose a preventive contact point before risk worsens.",
        "Create an advisor task for qualification.",
    ),
)
RECOMMENDATION_COLUMNS = (
    "recommendation_id", "observation_date", "customer_id", "split_name", "first_name", "last_name", "priority_tier",
    "priority_score", "churn_probability", "expected_saved_value", "recommended_action_type", "recommended_channel",
    "recommended_offer", "estimated_offer_value", "advisor_message", "decision_rationale", "next_best_step",
    "human_review_status", "approval_decision", "approval_comment", "mlflow_run_id",
)


def strategy_catalog(spark: SparkSession) -> DataFrame:
    """The six strategies as literal rows in the plan."""
    return spark.createDataFrame(
        [tuple(s) for s in STRATEGIES],
        "recommended_action_type STRING, offer_label STRING, message_template STRING, default_next_step STRING",
    )


def queue_for_review(queue: DataFrame, limit: int | None = None, tiers: Sequence[str] = ("CRITICAL", "HIGH", "MEDIUM")) -> DataFrame:
    """All rows of the given tiers, best first; only the first ``limit`` if one is given."""
    ordered = queue.filter(F.col("priority_tier").isin(*tiers)).orderBy(
        F.desc("priority_score"), F.desc("expected_saved_value"), "customer_id", "observation_date"
    )
    return ordered if limit is None else ordered.limit(limit)


def with_strategy(queue: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    if catalog is not None:
        return with_default(queue, catalog, "recommended_action_type", DEFAULT_ACTION)
    by_action = {s[0]: s[1:] for s in STRATEGIES}

    def column(i: int) -> Column:
        chain = F.when(F.lit(False), F.lit(""))
        for action, values in by_action.items():
            chain = chain.when(F.col("recommended_action_type") == action, values[i])
        return chain.otherwise(by_action[DEFAULT_ACTION][i])

    return queue.withColumns({"offer_label": column(0), "message_template": column(1), "default_next_step": column(2)})


def recommendation_id() -> Column:
    identity = F.concat_ws("|", F.col("observation_date").cast("string"), "customer_id", "mlflow_run_id")
    return F.concat(F.lit("REC_"), F.upper(F.substring(F.sha1(identity.cast("binary")), 1, 16)))


def recommended_offer() -> Column:
    return F.concat("offer_label", F.lit(" - max budget "), money_text("estimated_offer_value"), F.lit(" EUR"))


def advisor_message() -> Column:
    return F.concat(
        "first_name", F.lit(" "), "last_name", F.lit(": "), "message_template",
        F.lit(" Recommended channel: "), "recommended_channel", F.lit("."),
    )


def decision_rationale() -> Column:
    percent = fixed_text(F.col("churn_probability").cast("double") * 100, 1)
    return F.concat(
        F.lit("Priority "), "priority_tier", F.lit(" with score "), money_text("priority_score"),
        F.lit(". Churn probability "), percent, F.lit("%. Expected saved value "), money_text("expected_saved_value"),
        F.lit(" EUR. Reasons: "), "action_reason", F.lit("."),
    )


def recommend(queue: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """One recommendation per queue row, waiting for review."""
    return with_strategy(queue, catalog).withColumns({
        "recommendation_id": recommendation_id(),
        "recommended_offer": recommended_offer(),
        "advisor_message": advisor_message(),
        "decision_rationale": decision_rationale(),
        "next_best_step": F.col("default_next_step"),
        "human_review_status": F.lit("PENDING_REVIEW"),
        "approval_decision": F.lit(None).cast("string"),
        "approval_comment": F.lit(None).cast("string"),
    }).select(*RECOMMENDATION_COLUMNS)


def contact_drafts(recommendations: DataFrame) -> DataFrame:
    """Subject, body, channel and approval flag per recommendation; absent fields take their defaults."""
    # Defaults of the draft's fields.
    defaults = {
        "first_name": "", "last_name": "", "recommended_offer": "a personalized advisor check-in",
        "decision_rationale": "", "next_best_step": "Schedule an advisor contact.", "recommended_channel": "EMAIL",
    }
    field = {
        c: F.coalesce(F.col(c).cast("string"), F.lit(d)) if c in recommendations.columns else F.lit(d)
        for c, d in defaults.items()
    }
    keys = [c for c in ("recommendation_id", "customer_id") if c in recommendations.columns]
    # The draft's wording.
    body = F.concat(
        F.lit("Hello "), field["first_name"], F.lit(" "), field["last_name"], F.lit(",\n\n"),
        F.lit("We would like to review your policy with you to make sure your coverage still matches your current needs.\n\n"),
        F.lit("Recommended offer: "), field["recommended_offer"], F.lit(".\nAdvisor context: "), field["decision_rationale"],
        F.lit("\nNext step: "), field["next_best_step"],
        F.lit("\n\nThis message is a draft and must be approved by an advisor before sending."),
    )
    return recommendations.select(
        *keys, F.lit("Let's review your policy").alias("subject"), body.alias("body"),
        field["recommended_channel"].alias("channel"), F.lit(True).alias("requires_human_approval"),
    )
