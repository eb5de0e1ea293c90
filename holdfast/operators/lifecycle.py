"""Customer and policy life-cycle operators: lifetime totals, segments, statuses, schedules, event log,
and the stratified weighted sampler."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import band, even_round, number
from holdfast.operators.snapshot import DIGITAL_CHANNELS, LATE_STATUSES

# Months per payment frequency and days per month of an instalment.
FREQUENCY_MONTHS = {"MONTHLY": 1, "QUARTERLY": 3, "ANNUAL": 12}
INSTALMENT_DAYS = 30


def lifetime_totals(
    customers: DataFrame, policies: DataFrame, payments: DataFrame, claims: DataFrame, cases: DataFrame,
    interactions: DataFrame,
) -> DataFrame:
    """Whole-history totals per customer: all facts in one union and one aggregate by customer."""
    one = F.lit(1)
    parts = [
        customers.select("customer_id", one.alias("_present")),
        policies.select(
            "customer_id", one.alias("policy_count"),
            F.when(F.col("policy_status") == "ACTIVE", F.col("annual_premium").cast("decimal(12,2)")).alias("premium"),
        ),
        payments.filter(F.col("payment_status").isin(*LATE_STATUSES)).select("customer_id", one.alias("payment_incidents")),
        claims.select("customer_id", one.alias("claims"), F.col("claim_amount").cast("decimal(14,2)").alias("claim_amount")),
        cases.select(
            "customer_id", one.alias("service_satisfaction_count"),
            F.coalesce(F.col("satisfaction_score").cast("decimal(4,2)"), F.lit(3).cast("decimal(4,2)"))
            .alias("service_satisfaction_sum"),
            F.when(F.col("case_type") == "COMPLAINT", 1).alias("complaints"),
        ),
        interactions.select(
            "customer_id", one.alias("interactions"),
            F.when(F.col("channel_id").isin(*DIGITAL_CHANNELS), 1).alias("digital_interactions"),
        ),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = ("policy_count", "payment_incidents", "claims", "complaints", "service_satisfaction_count",
              "interactions", "digital_interactions")
    amounts = ("premium", "claim_amount", "service_satisfaction_sum")
    return rows.groupBy("customer_id").agg(
        F.max("_present").alias("_present"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        *[F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in amounts],
    ).filter(F.col("_present").isNotNull()).drop("_present")


def customer_segment(as_of: Column) -> Column:
    """Segment cascade over the customer's own attributes."""
    age = F.floor(F.datediff(as_of, "birth_date") / F.lit(365.25))
    return (
        F.when(number("price_sensitivity_score") >= 0.72, "PRICE_SENSITIVE")
        .when(number("digital_engagement_score") >= 0.72, "DIGITAL_FIRST")
        .when((F.col("household_size") >= 3) & age.between(30, 58), "FAMILY_PROTECTOR")
        .when(F.col("estimated_income_band").isin("UPPER_MID", "HIGH") & (number("loyalty_score") >= 0.55), "HIGH_VALUE")
        .otherwise("LOW_ENGAGEMENT")
    )


def policy_status(as_of: Column) -> Column:
    """Status by dates alone: a cancellation date wins, then the end date decides."""
    return (
        F.when(F.col("cancellation_date").isNotNull(), "CANCELLED")
        .when(F.col("policy_end_date") >= as_of, "ACTIVE")
        .otherwise("EXPIRED")
    )


def instalments(policies: DataFrame, history_end: dt.date) -> DataFrame:
    """Due dates every 30 days per frequency month, up to the end, the history end or the cancellation."""
    months = reduce(
        lambda chain, item: chain.when(F.col("payment_frequency") == item[0], F.lit(item[1])),
        list(FREQUENCY_MONTHS.items())[1:],
        F.when(F.col("payment_frequency") == "MONTHLY", F.lit(FREQUENCY_MONTHS["MONTHLY"])),
    )
    last = F.least("policy_end_date", F.lit(history_end), "cancellation_date")
    start = F.col("policy_start_date")
    steps = F.floor(F.datediff(last, start) / (F.lit(INSTALMENT_DAYS) * F.col("_months"))).cast("int")
    due = F.transform(
        F.sequence(F.lit(0), F.col("_steps")),
        lambda i: F.date_add(start, i * F.col("_months") * INSTALMENT_DAYS),
    )
    return (
        policies.withColumn("_months", F.coalesce(months, F.lit(12)))
        .withColumn("_steps", steps)
        .filter(F.col("_steps") >= 0)
        .select(
            "policy_id", "customer_id", F.explode(due).alias("due_date"),
            even_round(F.col("annual_premium").cast("double") * F.col("_months") / F.lit(12.0), 2).alias("payment_amount"),
        )
    )


def policy_events(policies: DataFrame) -> DataFrame:
    """A subscription row per policy and a cancellation row per cancelled one, in one scan."""
    premium = F.col("annual_premium").cast("decimal(12,2)")
    no_text, no_amount = F.lit(None).cast("string"), F.lit(None).cast("decimal(12,2)")

    def event(day: Column, kind: str, reason: str, before: Column, after: str, old: Column, new: Column, change: Column) -> Column:
        return F.struct(
            day.alias("event_date"), F.lit(kind).alias("event_type"), F.lit(reason).alias("event_reason"),
            before.alias("previous_policy_status"), F.lit(after).alias("new_policy_status"),
            old.alias("previous_annual_premium"), new.alias("new_annual_premium"),
            change.cast("decimal(6,4)").alias("premium_change_pct"),
        )

    opened = event(F.col("policy_start_date"), "SUBSCRIPTION", "NEW_BUSINESS", no_text, "ACTIVE", no_amount, premium, F.lit(None))
    closed = F.when(F.col("cancellation_date").isNotNull(), event(
        F.col("cancellation_date"), "CANCELLATION", "CUSTOMER_REQUEST", F.lit("ACTIVE"), "CANCELLED", premium, premium, F.lit(0),
    ))
    return policies.select(
        "policy_id", "customer_id", "product_id", F.explode(F.array_compact(F.array(opened, closed))).alias("_e")
    ).select("policy_id", "customer_id", "product_id", "_e.*")


def sample_negatives(labels: DataFrame, minimum_rate: float, target_rate: float, seed: int = 42) -> DataFrame:
    """(split_name, observation_date, customer_id) of negatives drawn by weighted sampling without replacement.

    Per split as many as would lift the positive rate to the target where it lies below the minimum; labels stay as
    they are. A row's key is ln(u)/w, the logarithm of the classic u^(1/w) (which underflows for small weights), with
    u drawn from a digest of its identity; the largest keys win. The rank limit cuts inside every task.
    """
    weight = F.greatest(number("churn_probability"), F.lit(0.001))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("observation_date").cast("string"), F.col("customer_id")))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 1) / F.lit(float(2**48 + 1))
    stats = labels.groupBy("split_name").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("churn_label").alias("_positives")
    )
    floor_count = F.ceil(F.col("_rows") * F.lit(minimum_rate))
    wanted = F.greatest(floor_count, F.ceil(F.col("_rows") * F.lit(target_rate)))
    needs = stats.select(
        "split_name",
        F.when(F.col("_positives") >= floor_count, F.lit(0))
        .otherwise(F.least(wanted - F.col("_positives"), F.col("_rows") - F.col("_positives"))).alias("_needed"),
    )
    most = needs.agg(F.max("_needed")).first()[0] or 0
    order = Window.partitionBy("split_name").orderBy(F.desc(F.ln(u) / weight), "customer_id", "observation_date")
    placed = labels.filter(F.col("churn_label") == 0).withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= most)
    return placed.join(needs, "split_name").filter(F.col("_place") <= F.col("_needed")).select("split_name", "observation_date", "customer_id")


def prediction_band(probability: Column) -> Column:
    """Cuts of the stored prediction band."""
    return band(probability, ((0.08, "VERY_HIGH"), (0.05, "HIGH"), (0.035, "MEDIUM")), "LOW")
