"""Leakage audit: findings as rows of (check_name, status, severity, details)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.dates import as_date
from holdfast.functions.numeric import number
from holdfast.schemas import ALWAYS_EXCLUDED, FEATURE_COLUMNS, LABEL_ONLY_COLUMNS, SPLIT_COLUMN, TARGET_COLUMN

FORBIDDEN = LABEL_ONLY_COLUMNS + ALWAYS_EXCLUDED
MAX_PROXY_VALUES = 20


def _finding(check: str, status: Column, severity: Column, details: dict[str, Column]) -> list[Column]:
    entries = [part for key, value in details.items() for part in (F.lit(key), value.cast("string"))]
    return [
        F.lit(check).alias("check_name"), status.alias("status"), severity.alias("severity"),
        F.create_map(*entries).alias("details"),
    ]


def _graded(bad: Column, failed: str, severity: str) -> tuple[Column, Column]:
    return F.when(bad, failed).otherwise("passed"), F.when(bad, severity).otherwise("info")


def _skipped(df: DataFrame, check: str, missing: Sequence[str]) -> DataFrame:
    return df.sparkSession.range(1).select(
        *_finding(check, F.lit("skipped"), F.lit("info"), {"missing_columns": F.lit(",".join(sorted(missing)))})
    )


def contract_findings(df: DataFrame, features: Sequence[str], target: str = TARGET_COLUMN, forbidden: Sequence[str] = FORBIDDEN) -> DataFrame:
    """The two checks on names alone; the data is not read."""
    leaked = sorted(set(features) & set(forbidden))
    has_target = target in features
    one = df.sparkSession.range(1)
    names = one.select(*_finding(
        "forbidden_features_not_in_model_contract", *_graded(F.lit(bool(leaked)), "failed", "critical"),
        {"forbidden_features_found": F.lit(",".join(leaked))},
    ))
    own_target = one.select(*_finding(
        "target_not_in_features", *_graded(F.lit(has_target), "failed", "critical"),
        {"target_column": F.lit(target), "target_in_features": F.lit(has_target)},
    ))
    return names.unionByName(own_target)


def churn_date_finding(df: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Positives whose churn date lies before the observation."""
    check = "churn_date_after_observation"
    missing = {"observation_date", "churn_date", target} - set(df.columns)
    if missing:
        return _skipped(df, check, missing)
    early = (number(target) == 1) & (as_date("churn_date") < as_date("observation_date"))
    counted = df.agg(F.count_if(early).alias("n"))
    return counted.select(*_finding(
        check, *_graded(F.col("n") > 0, "failed", "critical"), {"invalid_positive_rows": F.col("n")}
    ))


def repeated_customers_finding(df: DataFrame) -> DataFrame:
    """Customers seen in several splits. Smallest and largest split name per customer suffice: no distinct count."""
    check = "same_customer_across_temporal_splits"
    missing = {"customer_id", SPLIT_COLUMN} - set(df.columns)
    if missing:
        return _skipped(df, check, missing)
    ends = df.groupBy("customer_id").agg(F.min(SPLIT_COLUMN).alias("a"), F.max(SPLIT_COLUMN).alias("b"))
    counted = ends.agg(F.count_if(F.col("a") != F.col("b")).alias("n"))
    note = "acceptable for temporal panel data, but not acceptable for random splitting"
    return counted.select(*_finding(
        check, *_graded(F.col("n") > 0, "warning", "medium"),
        {"customers_seen_in_multiple_splits": F.col("n"), "interpretation": F.lit(note)},
    ))


def perfect_proxies(df: DataFrame, features: Sequence[str], target: str = TARGET_COLUMN) -> DataFrame:
    """Features with 2 to 20 values (null counts as one) that fix the target completely, as (feature, value_count)."""
    present = [f for f in features if f in df.columns]
    long = df.select(
        number(target).alias("_y"), *[F.coalesce(F.col(f).cast("string"), F.lit("nan")).alias(f) for f in present],
    ).unpivot(["_y"], present, "feature", "value")
    groups = long.groupBy("feature", "value").agg(F.min("_y").alias("lo"), F.max("_y").alias("hi"))
    # A group's mean is 0 or 1 exactly when a 0/1 target is constant in it.
    pure = (F.col("lo") == F.col("hi")) & F.col("lo").isin(0.0, 1.0)
    per_feature = groups.groupBy("feature").agg(
        F.count(F.lit(1)).alias("value_count"), F.bool_and(F.coalesce(pure, F.lit(False))).alias("pure")
    )
    return per_feature.filter(F.col("pure") & F.col("value_count").between(2, MAX_PROXY_VALUES)).select("feature", "value_count")


def proxy_finding(df: DataFrame, features: Sequence[str], target: str = TARGET_COLUMN) -> DataFrame:
    check = "low_cardinality_features_not_perfect_target_proxy"
    if any(f in df.columns for f in features):
        found = perfect_proxies(df, features, target).agg(F.array_sort(F.collect_set("feature")).alias("f"))
    else:
        found = df.sparkSession.range(1).select(F.array().cast("array<string>").alias("f"))
    return found.select(*_finding(
        check, *_graded(F.size("f") > 0, "failed", "high"), {"suspicious_features": F.array_join("f", ",")}
    ))


def audit(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, target: str = TARGET_COLUMN) -> DataFrame:
    """All five findings."""
    return reduce(DataFrame.unionByName, [
        contract_findings(df, features, target), churn_date_finding(df, target), repeated_customers_finding(df),
        proxy_finding(df, features, target),
    ])


def assert_no_critical(report: DataFrame) -> DataFrame:
    """Raise when a critical check failed (an action on five rows)."""
    critical = report.filter((F.col("status") == "failed") & (F.col("severity") == "critical")).collect()
    if critical:
        raise ValueError(f"Critical data leakage detected: {[r.asDict() for r in critical]}")
    return report
