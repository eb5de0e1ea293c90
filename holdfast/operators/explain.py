"""Explainability: exact linear contributions and their global summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import fixed_text, number
from holdfast.schemas import CATEGORICAL_FEATURES


Levels = Mapping[str, Mapping[str, float]]
_TIE_DIGITS = 9


def _level_weight(feature: str, levels: Mapping[str, float]) -> Column:
    """Weight of the row's level; a level the model has not seen weighs nothing."""
    entries = [F.lit(x) for pair in levels.items() for x in pair]
    if not entries:
        return F.lit(0.0)
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.col(feature).cast("string")), F.lit(0.0))


def linear_contributions(
    df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float], keys: Sequence[str], levels: Levels | None = None,
) -> DataFrame:
    """Exact Shapley values of a linear model, one column per feature: w * (x - E[x]), and for a categorical
    feature the weight of its level less the mean level weight. Missing numbers count as the mean."""
    parts = [
        (F.lit(float(w)) * (F.coalesce(number(f), F.lit(float(means[f]))) - F.lit(float(means[f])))).alias(f)
        for f, w in weights.items()
    ]
    parts += [(_level_weight(f, w) - F.lit(float(means[f]))).alias(f) for f, w in (levels or {}).items()]
    return df.select(*keys, *parts)


def feature_means(df: DataFrame, features: Sequence[str], levels: Levels | None = None) -> dict[str, float]:
    """Means of the numeric features and of the level weights as literals (an action with one row)."""
    averages = [F.coalesce(F.avg(number(f)), F.lit(0.0)).alias(f) for f in features]
    averages += [F.coalesce(F.avg(_level_weight(f, w)), F.lit(0.0)).alias(f) for f, w in (levels or {}).items()]
    return df.agg(*averages).first().asDict()


def long_contributions(wide: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, feature, contribution) rows."""
    return wide.unpivot(list(keys), list(features), "feature", "contribution")


def impact_direction(mean: Column) -> Column:
    return (
        F.when(mean > 0, "increases_churn_risk").when(mean < 0, "decreases_churn_risk").otherwise("mixed_or_neutral")
    )


def summarize(wide: DataFrame, features: Sequence[str], categorical: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Global importance per feature, from one aggregate over the wide contributions of all rows.

    The per-feature rows appear only after the aggregate, so the data is never multiplied by the feature count.
    """
    aggregates = []
    for f in features:
        c = F.col(f)
        aggregates += [
            F.avg(F.abs(c)).alias(f"a_{f}"), F.avg(c).alias(f"m_{f}"),
            F.avg((c > 0).cast("double")).alias(f"p_{f}"),
        ]
    entries = F.array(*[
        F.struct(
            F.lit(f).alias("feature"), F.lit("categorical" if f in categorical else "numeric").alias("feature_type"),
            F.col(f"a_{f}").alias("mean_abs_shap"), F.col(f"m_{f}").alias("mean_shap"),
            F.col(f"p_{f}").alias("positive_impact_share"),
        ) for f in features
    ])
    rows = wide.agg(*aggregates).select(F.explode(entries).alias("_e")).select("_e.*")
    return rank_importance(rows)


def rank_importance(rows: DataFrame) -> DataFrame:
    """Add share of the total, direction and rank to one-row-per-feature importances.

    Shares that agree to nine digits rank as ties, by feature: the order of summation must not order equal features.
    """
    grouped = rows.withColumn("_g", F.lit(0))
    total = F.sum("mean_abs_shap").over(Window.partitionBy("_g"))
    tie = F.when(total > 0, F.round(F.col("mean_abs_shap") / total, _TIE_DIGITS)).otherwise(F.col("mean_abs_shap"))
    order = Window.partitionBy("_g").orderBy(F.desc("_tie"), "feature")
    return grouped.withColumn("_tie", tie).select(
        F.row_number().over(order).alias("rank"), "feature", "feature_type", "mean_abs_shap", "mean_shap",
        "positive_impact_share",
        F.when(total > 0, F.col("mean_abs_shap") / total * 100).otherwise(0.0).alias("normalized_importance_pct"),
        impact_direction(F.col("mean_shap")).alias("impact_direction"),
    ).orderBy("rank")


def explanation_report(
    summary: DataFrame, metrics: DataFrame | None, model_name: str, run_id: str | None, method: str, top_n: int,
    target: str = "churn_label",
) -> DataFrame:
    """One nested row: the top features, metrics by split and how to read the measures."""
    # The report's reading guide.
    guide = {
        "mean_abs_shap": "Global feature importance. Higher means the feature contributes more to model output.",
        "mean_shap": "Average signed contribution. Positive values push churn risk up, negative values push it down.",
        "positive_impact_share": "Share of sampled rows where the feature increased predicted churn risk.",
        "normalized_importance_pct": "Relative global importance across all model features.",
    }
    top = summary.filter(F.col("rank") <= top_n).agg(F.array_sort(F.collect_list(F.struct(*summary.columns))).alias("top_features"))
    report = top.select(
        F.lit("1.0").alias("schema_version"), F.current_timestamp().alias("generated_at_utc"),
        F.lit(model_name).alias("model_name"), F.lit(run_id).cast("string").alias("mlflow_run_id"),
        F.lit(target).alias("target"), F.lit(method).alias("explainability_method"),
        F.create_map(*[F.lit(x) for pair in guide.items() for x in pair]).alias("interpretation_contract"), "top_features",
    )
    if metrics is None:
        return report
    listed = metrics.agg(F.array_sort(F.collect_list(F.struct(*metrics.columns)))).scalar()
    return report.withColumn("metrics_by_split", listed)


def driver_lines(summary: DataFrame, top_n: int) -> DataFrame:
    """``feature: direction (x.x%)`` lines of the most important features."""
    share = fixed_text("normalized_importance_pct", 1)
    return summary.filter(F.col("rank") <= top_n).select(
        "rank", F.concat("feature", F.lit(": "), "impact_direction", F.lit(" ("), share, F.lit("%)")).alias("driver")
    ).orderBy("rank")
