"""Groups F (preprocessing, splits, leakage), I (model) and K (explainability)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators import explain, leakage, model, preprocess
from holdfast.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS, NUMERIC_FEATURES, SPLIT_ORDER
from proof.base import Tables, register

KEYS = ("observation_date", "customer_id")
_KEY_SQL = "CAST(observation_date AS VARCHAR) AS observation_date, customer_id"
_TRAIN = "(SELECT * FROM eng WHERE split_name = 'train')"


def _train(t: Tables) -> DataFrame:
    return t.engineered.filter("split_name = 'train'")


# --- F -------------------------------------------------------------------------------------------

register("f01_numeric_medians", lambda t: preprocess.numeric_medians(_train(t), NUMERIC_FEATURES), " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(coalesce(median(CAST({c} AS DOUBLE)), 0), 8) AS fill_value FROM {_TRAIN}" for c in NUMERIC_FEATURES
), 8)
register("f02_categorical_modes", lambda t: preprocess.categorical_modes(_train(t), CATEGORICAL_FEATURES), " UNION ALL ".join(
    f"(SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS fill_value FROM {_TRAIN} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in CATEGORICAL_FEATURES
))


def _prepared(t: Tables) -> DataFrame:
    def make() -> DataFrame:
        return preprocess.FillValues().fit(_train(t)).transform(t.engineered)

    return t._stored("prepared_panel", make)


_FILLED = (
    ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT coalesce(median(CAST({c} AS DOUBLE)), 0) FROM {_TRAIN})), 8) + 0 AS {c}"
              for c in ("avg_satisfaction_score_12m", "renewal_days_min", "days_since_last_contact", "tenure_months", "premium_per_policy"))
    + ", " + ", ".join(("renewal_window", "region", "main_product_family"))
)
register("f03_fill_missing", lambda t: _prepared(t).select(
    *KEYS, "avg_satisfaction_score_12m", "renewal_days_min", "days_since_last_contact", "tenure_months", "premium_per_policy", "renewal_window",
    "region", "main_product_family", "churn_label",
), f"SELECT {_KEY_SQL}, {_FILLED}, churn_label FROM eng", 8)


def _split_sizes(t: Tables) -> DataFrame:
    parts = preprocess.temporal_split(_prepared(t), validate=False)
    out = None
    for name, part in parts.items():
        rows = part.data.agg(
            F.lit(name).alias("split_name"), F.count(F.lit(1)).alias("rows"), F.sum("churn_label").alias("positives"),
            F.lit(len(part.features.columns)).alias("features"), F.min("observation_date").alias("first_day"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


register("f05_temporal_split", _split_sizes, f"""
SELECT split_name, count(*) AS rows, CAST(sum(churn_label) AS BIGINT) AS positives, {len(FEATURE_COLUMNS)} AS features, CAST(min(observation_date) AS VARCHAR) AS first_day
FROM eng GROUP BY split_name""")
register("f06_split_order", lambda t: preprocess.split_bounds(t.engineered), """
WITH declared(position, split_name) AS (VALUES (0, 'train'), (1, 'validation'), (2, 'test'), (3, 'backtest')),
bounds AS (SELECT split_name, min(observation_date) AS a, max(observation_date) AS b FROM eng GROUP BY split_name),
laid AS (SELECT position, split_name, a, b, lag(b) OVER (ORDER BY position) AS p FROM declared LEFT JOIN bounds USING (split_name))
SELECT position, split_name, CAST(a AS VARCHAR) AS first_time, CAST(b AS VARCHAR) AS last_time, CAST(p AS VARCHAR) AS previous_last_time,
  coalesce(a > p, a IS NOT NULL) AS ordered FROM laid""")
register("f07_class_distribution", lambda t: preprocess.class_distribution(t.engineered, order=SPLIT_ORDER), """
SELECT split_name, churn_label, count(*) AS rows, CAST(sum(count(*)) OVER (PARTITION BY split_name) AS BIGINT) AS total_rows,
  round(count(*) / sum(count(*)) OVER (PARTITION BY split_name), 8) AS share FROM eng GROUP BY split_name, churn_label""", 8)
register("f08_concat_splits", lambda t: preprocess.concat_splits([
    t.labels.filter(F.col("split_name") == s) for s in ("backtest", "train", "test", "validation")
]).groupBy("split_name").agg(F.count(F.lit(1)).alias("rows")), "SELECT split_name, count(*) AS rows FROM lab GROUP BY ALL")
register("f09_drop_columns", lambda t: t.labels.drop("label_reason", "churn_risk_band", "prediction_horizon_days"), f"""
SELECT {_KEY_SQL}, split_name, churn_label, CAST(churn_date AS VARCHAR) AS churn_date, customer_lifecycle_status, churn_probability FROM lab""")


def _shifted(t: Tables) -> DataFrame:
    """The panel with some churn dates moved before the observation, so that the check has something to find."""
    early = F.col("churn_date").isNotNull() & (F.col("split_name") == "test")
    return t.engineered.withColumn("churn_date", F.when(early, F.date_sub("observation_date", 5)).otherwise(F.col("churn_date")))


def _flat(findings: DataFrame) -> DataFrame:
    return findings.select("check_name", "status", "severity", F.to_json("details").alias("details"))


register("f12_churn_date_leak", lambda t: _flat(leakage.churn_date_finding(_shifted(t))), """
SELECT 'churn_date_after_observation' AS check_name, CASE WHEN count(*) > 0 THEN 'failed' ELSE 'passed' END AS status,
  CASE WHEN count(*) > 0 THEN 'critical' ELSE 'info' END AS severity, '{"invalid_positive_rows":"' || count(*) || '"}' AS details
FROM eng WHERE churn_label = 1 AND split_name = 'test'""")
register("f13_repeated_customers", lambda t: _flat(leakage.repeated_customers_finding(t.engineered)), """
SELECT 'same_customer_across_temporal_splits' AS check_name, 'warning' AS status, 'medium' AS severity, '{"customers_seen_in_multiple_splits":"' || count(*)
  || '","interpretation":"acceptable for temporal panel data, but not acceptable for random splitting"}' AS details
FROM (SELECT customer_id FROM eng GROUP BY customer_id HAVING count(DISTINCT split_name) > 1)""")


def _with_proxy(t: Tables) -> DataFrame:
    return t.engineered.withColumns({
        "proxy": F.when(F.col("churn_label") == 1, "yes").when(F.col("split_name") == "test", None).otherwise("no"),
        "constant": F.lit("x"),
    })


register("f14_perfect_proxies", lambda t: leakage.perfect_proxies(_with_proxy(t), ["proxy", "constant", "region", "main_product_family", "observation_year"]), """
SELECT 'proxy' AS feature, count(DISTINCT CASE WHEN churn_label = 1 THEN 'yes' WHEN split_name = 'test' THEN 'nan' ELSE 'no' END) AS value_count FROM eng""")
_NOTE = "acceptable for temporal panel data, but not acceptable for random splitting"
_ALL_FEATURES = ", ".join(FEATURE_COLUMNS)
register("f15_leakage_audit", lambda t: _flat(leakage.audit(t.engineered)), f"""
WITH levels AS (SELECT feature, value, min(churn_label) AS lo, max(churn_label) AS hi FROM (
    SELECT churn_label, {', '.join(f"coalesce(CAST({c} AS VARCHAR), 'nan') AS {c}" for c in FEATURE_COLUMNS)} FROM eng)
  UNPIVOT (value FOR feature IN ({_ALL_FEATURES})) GROUP BY ALL),
proxies AS (SELECT feature FROM levels GROUP BY feature HAVING bool_and(lo = hi AND lo IN (0, 1)) AND count(*) BETWEEN 2 AND 20),
found AS (SELECT count(*) AS n, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS names FROM proxies),
early AS (SELECT count(*) AS n FROM eng WHERE churn_label = 1 AND churn_date < observation_date),
again AS (SELECT count(*) AS n FROM (SELECT customer_id FROM eng GROUP BY customer_id HAVING count(DISTINCT split_name) > 1))
SELECT * FROM (VALUES
  ('forbidden_features_not_in_model_contract', 'failed', 'critical', '{{"forbidden_features_found":"latent_churn_risk_band"}}'),
  ('target_not_in_features', 'passed', 'info', '{{"target_column":"churn_label","target_in_features":"false"}}')) v(check_name, status, severity, details)
UNION ALL SELECT 'churn_date_after_observation', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END, CASE WHEN n > 0 THEN 'critical' ELSE 'info' END,
  '{{"invalid_positive_rows":"' || n || '"}}' FROM early
UNION ALL SELECT 'same_customer_across_temporal_splits', CASE WHEN n > 0 THEN 'warning' ELSE 'passed' END, CASE WHEN n > 0 THEN 'medium' ELSE 'info' END,
  '{{"customers_seen_in_multiple_splits":"' || n || '","interpretation":"{_NOTE}"}}' FROM again
UNION ALL SELECT 'low_cardinality_features_not_perfect_target_proxy', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END,
  CASE WHEN n > 0 THEN 'high' ELSE 'info' END, '{{"suspicious_features":"' || names || '"}}' FROM found""")

# --- I: trained model, rows only (the boosting library has no SQL form) ---------------------------

_MODEL_NUMERIC = tuple(c for c in NUMERIC_FEATURES)
_MODEL_CATEGORICAL = tuple(c for c in CATEGORICAL_FEATURES if c != "latent_churn_risk_band")


def _boosted(t: Tables) -> model.Boosted:
    key = (t.spark.sparkContext.applicationId, t.folder, "gbt")
    if key not in _MODELS:
        _MODELS[key] = model.boost(_prepared(t), _MODEL_NUMERIC, _MODEL_CATEGORICAL)
    return _MODELS[key]


def _trained(t: Tables):
    return _boosted(t).model


def _growth(t: Tables) -> DataFrame:
    """The validation metrics of every tree up to the stop, and which one was kept."""
    boosted = _boosted(t)
    rows = t.spark.createDataFrame(boosted.validation, "iteration INT, validation_auc DOUBLE, validation_logloss DOUBLE")
    return rows.withColumns({"kept": F.col("iteration") <= boosted.best, "stopped_at": F.lit(boosted.stopped)})


def _grid(t: Tables) -> DataFrame:
    _, results = model.grid_search(_prepared(t), _MODEL_NUMERIC, _MODEL_CATEGORICAL)
    rows = [(p["maxIter"], p["stepSize"], p["maxDepth"], auc) for p, auc in results]
    return t.spark.createDataFrame(rows, "iterations INT, learning_rate DOUBLE, depth INT, validation_auc DOUBLE")


_MODELS: dict = {}
register("i01_boosting_with_patience", _growth)
register("i02_grid_search", _grid)
register("i03_model_scores", lambda t: model.score(_trained(t), _prepared(t).filter("split_name <> 'train'")))
register("i04_prediction_rows", lambda t: model.prediction_rows(
    t.wide.filter("split_name <> 'train'").select(*KEYS, "split_name", F.col("raw_churn_probability").alias("score")),
    0.14, "rule_score", "run-b", F.lit("2001-07-05").cast("timestamp"),
).drop("scored_at"), f"""
SELECT {_KEY_SQL}, split_name, churn_probability, predicted_churn_label, churn_risk_band, model_name, model_version, mlflow_run_id
FROM pred WHERE mlflow_run_id = 'run-b'""")
def _model_curve(t: Tables) -> DataFrame:
    return t._stored("training_curve", lambda: model.training_curve(_boosted(t), {
        "learn": _prepared(t).filter("split_name = 'train'"), "validation": _prepared(t).filter("split_name = 'validation'"),
    }))


register("i05_training_curve", _model_curve)
register("i06_model_diagnostics", lambda t: model.training_diagnostics(_model_curve(t)))


def _curve(t: Tables) -> DataFrame:
    """Log loss of the rule score under rising shrinkage, one 'iteration' per step, on train and validation rows."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("iteration")
    rows = t.scores.filter("split_name IN ('train', 'validation')").select("split_name", "label", "score", steps)
    p = F.least(F.greatest(F.col("score") * F.col("iteration") / F.lit(4.0), F.lit(0.001)), F.lit(0.999))
    loss = -(F.when(F.col("label") == 1, F.ln(p)).otherwise(F.ln(F.lit(1.0) - p)))
    return rows.withColumn("_loss", loss).groupBy("iteration", F.when(F.col("split_name") == "train", "learn").otherwise("validation").alias("dataset")).agg(
        F.lit("Logloss").alias("metric"), F.round(F.avg("_loss"), 9).alias("value")
    )


register("i06_training_diagnostics", lambda t: model.training_diagnostics(_curve(t)), """
WITH losses AS (SELECT i AS iteration, split_name, round(avg(-CASE label WHEN 1 THEN ln(least(greatest(score * i / 4e0, 0.001e0), 0.999e0))
    ELSE ln(1 - least(greatest(score * i / 4e0, 0.001e0), 0.999e0)) END), 9) AS v
  FROM scores CROSS JOIN range(1, 9) r(i) WHERE split_name IN ('train', 'validation') GROUP BY ALL),
wide AS (SELECT iteration, max(v) FILTER (split_name = 'train') AS learn, max(v) FILTER (split_name = 'validation') AS validation FROM losses GROUP BY iteration)
SELECT arg_min(iteration, validation) AS best_validation_iteration, round(min(validation), 8) AS best_validation_logloss, max(iteration) AS final_iteration,
  round(arg_max(learn, iteration), 8) AS final_train_logloss, round(arg_max(validation, iteration), 8) AS final_validation_logloss,
  round(arg_max(validation, iteration) - arg_max(learn, iteration), 8) AS final_logloss_gap_validation_minus_train FROM wide""", 8)

# --- K: explainability with fixed weights --------------------------------------------------------

_WEIGHTS = {"price_sensitivity_score": 1.35, "service_sensitivity_score": 0.55, "complaints_6m": 0.34, "loyalty_score": -1.25, "number_of_products": -0.16}


def _contributions(t: Tables) -> DataFrame:
    return explain.linear_contributions(t.engineered, _WEIGHTS, explain.feature_means(t.engineered, list(_WEIGHTS)), KEYS)


_CONTRIB = "contrib AS (SELECT observation_date, customer_id, " + ", ".join(
    f"{w}e0 * ({f} - avg({f}) OVER ()) AS {f}" for f, w in _WEIGHTS.items()
) + " FROM eng)"
register("k01_linear_contributions", lambda t: explain.long_contributions(_contributions(t), list(_WEIGHTS), KEYS), f"""
WITH {_CONTRIB} SELECT {_KEY_SQL}, feature, round(contribution, 7) + 0 AS contribution FROM contrib UNPIVOT (contribution FOR feature IN ({', '.join(_WEIGHTS)}))""", 7)
_SUMMARY = f"""{_CONTRIB}, long AS (SELECT feature, c FROM contrib UNPIVOT (c FOR feature IN ({', '.join(_WEIGHTS)}))),
agg AS (SELECT feature, avg(abs(c)) AS a, avg(c) AS m, avg(CASE WHEN c > 0 THEN 1 ELSE 0 END) AS p FROM long GROUP BY feature),
ranked_features AS (SELECT row_number() OVER (ORDER BY a DESC, feature) AS rank, feature, a, m, p, a / sum(a) OVER () * 100 AS pct FROM agg)"""
def _against_kept(t: Tables) -> DataFrame:
    """Contributions of all rows against the means of the rows without churn, so that signs differ by feature."""
    means = explain.feature_means(t.engineered.filter("churn_label = 0"), list(_WEIGHTS))
    return explain.linear_contributions(t.engineered, _WEIGHTS, means, KEYS)


_SIGNED = f"""means AS (SELECT {', '.join(f'avg({f}) AS {f}' for f in _WEIGHTS)} FROM eng WHERE churn_label = 0),
shifted AS (SELECT {', '.join(f'{w}e0 * (e.{f} - m.{f}) AS {f}' for f, w in _WEIGHTS.items())} FROM eng e CROSS JOIN means m),
agg AS (SELECT feature, avg(abs(c)) AS a, avg(c) AS m, avg(CASE WHEN c > 0 THEN 1 ELSE 0 END) AS p
  FROM shifted UNPIVOT (c FOR feature IN ({', '.join(_WEIGHTS)})) GROUP BY feature),
placed AS (SELECT row_number() OVER (ORDER BY a DESC, feature) AS rank, feature, a, m, p, a / sum(a) OVER () * 100 AS pct,
  CASE WHEN m > 0 THEN 'increases_churn_risk' WHEN m < 0 THEN 'decreases_churn_risk' ELSE 'mixed_or_neutral' END AS direction FROM agg)"""
register("k02_importance_summary", lambda t: explain.summarize(_against_kept(t), list(_WEIGHTS)), f"""
WITH {_SIGNED} SELECT rank, feature, 'numeric' AS feature_type, round(a, 7) AS mean_abs_shap, round(m, 7) + 0 AS mean_shap,
  round(p, 7) AS positive_impact_share, round(pct, 7) AS normalized_importance_pct, direction AS impact_direction FROM placed""", 7)
register("k03_impact_direction", lambda t: explain.summarize(_against_kept(t), list(_WEIGHTS)).select("feature", "impact_direction"),
         f"WITH {_SIGNED} SELECT feature, direction AS impact_direction FROM placed")
register("k04_explanation_report", lambda t: explain.explanation_report(
    explain.summarize(_contributions(t), list(_WEIGHTS)), None, "rule_score", "run-b", "linear contributions", 3
).select("schema_version", "model_name", "mlflow_run_id", "target", "explainability_method", F.expr("transform(top_features, x -> x.feature)").alias("top_features")), f"""
WITH {_SUMMARY} SELECT '1.0' AS schema_version, 'rule_score' AS model_name, 'run-b' AS mlflow_run_id, 'churn_label' AS target,
  'linear contributions' AS explainability_method, string_agg(feature, ',' ORDER BY rank) AS top_features FROM ranked_features WHERE rank <= 3""")
register("k05_driver_lines", lambda t: explain.driver_lines(explain.summarize(_against_kept(t), list(_WEIGHTS)), 3), f"""
WITH {_SIGNED} SELECT rank, feature || ': ' || direction || ' (' || printf('%.1f', round_even(pct * 10, 0) / 10) || '%)' AS driver FROM placed WHERE rank <= 3""")
