"""KPI tables over labels, queue and recommendations. Rates round half up, the rule of SQL numerics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.dates import week_start
from holdfast.operators.marts import queue_with_recommendations
from holdfast.operators.preprocess import split_rank
from holdfast.schemas import REPORT_SPLIT_ORDER

# The columns of the two listings.
_PRIORITY_LISTING = (
    "customer_id", "first_name", "last_name", "split_name", "region", "agency_name", "main_product_family",
    "priority_tier", "priority_score", "churn_probability", "expected_saved_value", "recommended_action_type",
    "recommended_channel", "action_reason", "business_context", "mlflow_run_id",
)
_RECOMMENDATION_LISTING = (
    "recommendation_id", "customer_id", "first_name", "last_name", "priority_tier", "priority_score",
    "churn_probability", "expected_saved_value", "recommended_action_type", "recommended_channel",
    "recommended_offer", "estimated_offer_value", "advisor_message", "decision_rationale", "next_best_step",
    "human_review_status", "mlflow_run_id",
)


def _money(c: str, digits: int = 2) -> Column:
    """Exact sum: the values enter as decimals."""
    return F.sum(F.col(c).cast("decimal(14,2)")).cast(f"decimal(24,{digits})")


def _mean(c: str, scale: int, digits: int) -> Column:
    """Mean of a decimal column, rounded half up."""
    total = F.sum(F.col(c).cast(f"decimal(14,{scale})"))
    return F.round(total.cast("decimal(28,10)") / F.count(c), digits)


def churn_rates(labels: DataFrame, order: Sequence[str] = REPORT_SPLIT_ORDER) -> DataFrame:
    """Rows, churned rows and churn rate per split, in the given order."""
    rates = labels.groupBy("split_name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("churn_label").alias("churn_rows"),
        F.round(F.sum("churn_label").cast("decimal(28,10)") / F.count("churn_label"), 4).alias("churn_rate"),
    )
    return rates.orderBy(split_rank(order), "split_name")


def priority_clients(queue: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    """Clients, mean probability and saved value by the given columns and tier, every group."""
    keys = [*by, "priority_tier"]
    return queue.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("clients"), _mean("churn_probability", 6, 4).alias("avg_churn_probability"),
        _money("expected_saved_value").alias("expected_saved_value"),
    ).orderBy(F.desc("expected_saved_value"), F.desc("clients"), *keys)


def action_distribution(recommendations: DataFrame) -> DataFrame:
    keys = ["recommended_action_type", "recommended_channel"]
    return recommendations.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("recommendations"), _mean("priority_score", 2, 2).alias("avg_priority_score"),
        _mean("churn_probability", 6, 4).alias("avg_churn_probability"),
    ).orderBy(F.desc("recommendations"), F.desc("avg_priority_score"), *keys)


def weekly_contacts(queue: DataFrame, recommendations: DataFrame, as_of: Column) -> DataFrame:
    """Customers scored since Monday per agency, with the approved share of their recommendations."""
    fresh = queue.filter(F.col("scored_at") >= week_start(as_of))
    approved = F.when(F.col("human_review_status") == "APPROVED", 1).otherwise(0)
    return queue_with_recommendations(fresh, recommendations).groupBy("agency_name", "region").agg(
        F.count(F.lit(1)).alias("customers_to_contact"), _mean("churn_probability", 6, 4).alias("avg_churn_probability"),
        F.round(F.sum(approved).cast("decimal(28,10)") / F.count(F.lit(1)), 4).alias("approved_action_rate"),
    ).orderBy(F.desc("customers_to_contact"), F.desc("avg_churn_probability"), "agency_name", "region")


def customer_count(customers: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return customers.agg(count("customer_id").alias("total_customers"))


def top_priority_clients(queue: DataFrame, limit: int) -> DataFrame:
    return queue.select(*_PRIORITY_LISTING).orderBy(
        F.desc("priority_score"), F.desc("expected_saved_value"), F.desc("churn_probability"), "customer_id", "split_name"
    ).limit(limit)


def top_recommendations(recommendations: DataFrame, limit: int) -> DataFrame:
    return recommendations.select(*_RECOMMENDATION_LISTING).orderBy(
        F.desc("priority_score"), F.desc("expected_saved_value"), F.desc("churn_probability"), "recommendation_id"
    ).limit(limit)


def volume_summary(df: DataFrame, keys: Sequence[str], means: Sequence[str] = (), sums: Sequence[str] = (), count: str = "rows") -> DataFrame:
    """Grouped count with means and sums; a null key is a group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count), *[F.avg(c).alias(f"avg_{c}") for c in means], *[F.sum(c).alias(f"total_{c}") for c in sums]
    ).orderBy(*keys)


def chart_rows(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows in rising order of their category's total, then category; for aggregated tables."""
    total = F.sum(y).over(Window.partitionBy(x))
    return df.withColumn("_total", total).orderBy("_total", x, y).drop("_total")


def leading_category(df: DataFrame, x: str, y: str) -> DataFrame:
    """The category with the largest measure; ties go to the smaller category."""
    best = df.agg(F.min(F.struct((-F.col(y)).alias("m"), F.col(x).alias("c"))).alias("_b"))
    return best.select(F.col("_b.c").alias(x), (-F.col("_b.m")).alias(y))
