"""Feature selection driven by the drift report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.schemas import (
    ALWAYS_EXCLUDED, CATEGORICAL_FEATURES, ENGINEERED_CATEGORICAL, ENGINEERED_NUMERIC, FEATURE_INPUTS,
    NUMERIC_FEATURES, PROTECTED_COLUMNS,
)


def feature_contract(
    spark: SparkSession, raw_columns: Sequence[str], numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES, protected: Sequence[str] = PROTECTED_COLUMNS,
    excluded: Sequence[str] = ALWAYS_EXCLUDED,
) -> DataFrame:
    """The model contract as literal rows: (position, feature, feature_type, is_engineered, is_raw, always_excluded, inputs)."""
    engineered, raw, kept = set(ENGINEERED_NUMERIC + ENGINEERED_CATEGORICAL), set(raw_columns), set(protected)
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("feature"), F.lit(kind).alias("feature_type"),
            F.lit(name in engineered).alias("is_engineered"), F.lit(name in raw and name not in kept).alias("is_raw"),
            F.lit(name in excluded).alias("always_excluded"),
            F.array(*[F.lit(c) for c in FEATURE_INPUTS.get(name, ())]).cast("array<string>").alias("inputs"),
        )
        for i, (name, kind) in enumerate([(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical])
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def drifting_features(report: DataFrame, level: str = "high", reference: str = "train") -> DataFrame:
    hit = (F.col("reference_split") == reference) & (F.col("severity") == level)
    if "is_reference_comparison" in report.columns:
        hit = hit & (F.lower(F.col("is_reference_comparison").cast("string")) == "true")
    return report.filter(hit & F.col("feature").isNotNull()).select("feature").distinct()


def select_features(report: DataFrame, contract: DataFrame, level: str = "high", reference: str = "train") -> DataFrame:
    """The contract with ``drifted``, ``drop_raw``, ``removed`` and ``selected`` flags.

    A feature goes when it drifts, is always excluded, or one of its inputs is a dropped raw column.
    """
    drifted = drifting_features(report, level, reference).withColumn("drifted", F.lit(True))
    flagged = contract.join(drifted, "feature", "left").withColumn(
        "drifted", F.coalesce("drifted", F.lit(False)) | F.col("always_excluded")
    ).withColumn("drop_raw", F.col("drifted") & F.col("is_raw"))
    dropped = flagged.filter("drop_raw").select(F.col("feature").alias("input"), F.lit(True).alias("_gone"))
    edges = flagged.select("feature", F.explode("inputs").alias("input"))
    broken = edges.join(dropped, "input", "left_semi").select("feature").distinct().withColumn("input_dropped", F.lit(True))
    out = flagged.join(broken, "feature", "left").withColumn("input_dropped", F.coalesce("input_dropped", F.lit(False)))
    return out.select(
        "position", "feature", "feature_type", "is_engineered", "drifted", "drop_raw", "input_dropped",
        (F.col("drifted") | F.col("input_dropped")).alias("removed"),
        (~(F.col("drifted") | F.col("input_dropped"))).alias("selected"),
    )


def selection_summary(selection: DataFrame) -> DataFrame:
    """One row of name lists: the lists that name removals are sorted, the selected ones keep contract order."""
    def names(condition: str, by: str = "feature"):
        entry = F.when(F.expr(condition), F.struct(F.col(by).alias("o"), F.col("feature").alias("f")))
        return F.transform(F.array_sort(F.collect_list(entry)), lambda s: s["f"])

    lists = selection.agg(
        names("removed").alias("features_to_remove"),
        names("drop_raw").alias("raw_columns_to_drop"),
        names("selected AND feature_type = 'numeric'", "position").alias("selected_numeric_features"),
        names("selected AND feature_type = 'categorical'", "position").alias("selected_categorical_features"),
        names("removed AND is_engineered").alias("excluded_engineered_features"),
    )
    return lists.withColumn(
        "selected_feature_columns", F.concat("selected_numeric_features", "selected_categorical_features")
    ).withColumn("protected_columns", F.array(*[F.lit(c) for c in sorted(PROTECTED_COLUMNS)]))


def removal_reasons(report: DataFrame, selection: DataFrame) -> DataFrame:
    """Reference rows of the removed features, by feature, severity and PSI."""
    rows = report.join(selection.filter("drifted").select("feature"), "feature", "left_semi")
    if "is_reference_comparison" in report.columns:
        rows = rows.filter(F.lower(F.col("is_reference_comparison").cast("string")) == "true")
    return rows.select(
        "feature", "feature_type", "reference_split", "comparison_split", "psi", "secondary_metric_name",
        "secondary_metric", "missing_rate_delta", "severity", "severity_rank",
    ).orderBy("feature", F.desc("severity_rank"), F.desc("psi"), "comparison_split").drop("severity_rank")


def drop_raw_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
