"""Groups G (drift), H (selection) and J (metrics)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from holdfast.operators import drift, marts, metrics, selection
from holdfast.schemas import (
    ALWAYS_EXCLUDED, CATEGORICAL_FEATURES, DRIFT_REPORT_SCHEMA, ENGINEERED_CATEGORICAL, ENGINEERED_NUMERIC, FEATURE_INPUTS, NUMERIC_FEATURES,
    PROTECTED_COLUMNS,
)
from holdfast.session import ensure_checkpoint_dir
from holdfast.sources import reports, sinks
from proof.base import THRESHOLD, Tables, ev, register

# --- G: drift ------------------------------------------------------------------------------------

_NUM = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in (*NUMERIC_FEATURES, "churn_label"))
_CAT = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__MISSING__') AS {c}" for c in CATEGORICAL_FEATURES)
_EPS = "greatest({}, 1e-6)"


def _psi(p: str, q: str) -> str:
    a, b = _EPS.format(p), _EPS.format(q)
    return f"({b} - {a}) * ln({b} / {a})"


_DRIFT_VIEWS = f"""
pairs(ref, cmp) AS (VALUES ('train', 'validation'), ('train', 'backtest'), ('train', 'test'), ('validation', 'backtest'),
  ('validation', 'test'), ('backtest', 'test')),
rows_of AS (SELECT split_name, CAST(count(*) AS DOUBLE) AS n FROM eng GROUP BY ALL),
num AS (SELECT split_name, feature, value FROM (SELECT split_name, {_NUM} FROM eng)
  UNPIVOT (value FOR feature IN ({', '.join((*NUMERIC_FEATURES, 'churn_label'))}))),
cat AS (SELECT split_name, feature, value FROM (SELECT split_name, {_CAT} FROM eng)
  UNPIVOT (value FOR feature IN ({', '.join(CATEGORICAL_FEATURES)}))),
num_stats AS (SELECT feature, split_name, CAST(count(*) AS DOUBLE) AS valid, avg(value) AS mean,
  list_sort(list_distinct(quantile_cont(value, [0e0, 0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0, 1e0]))) AS edges
  FROM num GROUP BY ALL),
num_counts AS (SELECT feature, split_name, value, CAST(count(*) AS DOUBLE) AS n FROM num GROUP BY ALL),
num_pairs AS (SELECT p.*, r.feature, r.valid AS r_valid, c.valid AS c_valid, r.mean AS r_mean, c.mean AS c_mean, r.edges, rr.n AS r_rows, cc.n AS c_rows
  FROM pairs p JOIN num_stats r ON r.split_name = ref JOIN num_stats c ON c.split_name = cmp AND c.feature = r.feature
  JOIN rows_of rr ON rr.split_name = ref JOIN rows_of cc ON cc.split_name = cmp),
bins AS (SELECT ref, cmp, feature, len(list_filter(edges[2:len(edges) - 1], lambda e: e < value)) AS bin, any_value(r_valid) AS r_valid, any_value(c_valid) AS c_valid,
    sum(CASE WHEN split_name = ref THEN k.n ELSE 0 END) AS r, sum(CASE WHEN split_name = cmp THEN k.n ELSE 0 END) AS c
  FROM num_pairs JOIN num_counts k USING (feature) WHERE split_name IN (ref, cmp) GROUP BY ALL),
bin_psi AS (SELECT ref, cmp, feature, sum({_psi('r / r_valid', 'c / c_valid')}) AS psi FROM bins GROUP BY ALL),
single AS (
  SELECT ref, cmp, feature, CAST(value AS VARCHAR) AS value, any_value(r_rows) AS r_rows, any_value(c_rows) AS c_rows,
    sum(CASE WHEN split_name = ref THEN k.n ELSE 0 END) AS r, sum(CASE WHEN split_name = cmp THEN k.n ELSE 0 END) AS c
  FROM num_pairs JOIN num_counts k USING (feature) WHERE split_name IN (ref, cmp) GROUP BY ALL
  UNION ALL SELECT ref, cmp, feature, '__MISSING__', r_rows, c_rows, r_rows - r_valid, c_rows - c_valid FROM num_pairs),
single_psi AS (SELECT ref, cmp, feature, sum({_psi('r / r_rows', 'c / c_rows')}) AS psi FROM single WHERE r + c > 0 GROUP BY ALL),
steps AS (SELECT feature, value, split_name, sum(n) OVER (PARTITION BY feature, split_name ORDER BY value) AS below FROM num_counts),
grid AS (SELECT DISTINCT feature, value FROM num_counts),
cumulative AS (SELECT g.feature, g.value, s.split_name, max(s.below) OVER (PARTITION BY g.feature, t.split_name ORDER BY g.value) AS below, t.split_name AS side
  FROM grid g CROSS JOIN (SELECT split_name FROM rows_of) t LEFT JOIN steps s ON s.feature = g.feature AND s.value = g.value AND s.split_name = t.split_name),
ks AS (SELECT p.ref, p.cmp, p.feature, max(abs(coalesce(a.below, 0) / r_valid - coalesce(b.below, 0) / c_valid)) AS d
  FROM num_pairs p JOIN cumulative a ON a.feature = p.feature AND a.side = ref JOIN cumulative b ON b.feature = p.feature AND b.value = a.value AND b.side = cmp
  GROUP BY ALL),
num_rows AS (
  SELECT p.ref, p.cmp, p.feature, CASE WHEN p.feature = 'churn_label' THEN 'target' ELSE 'numeric' END AS feature_type,
    CASE WHEN p.feature <> 'churn_label' AND len(edges) >= 3 THEN b.psi ELSE s.psi END AS psi,
    CASE WHEN p.feature = 'churn_label' THEN 'churn_rate_delta' ELSE 'ks_statistic' END AS secondary_metric_name,
    CASE WHEN p.feature = 'churn_label' THEN abs(r_mean - c_mean) ELSE d END AS secondary_metric,
    CASE WHEN p.feature <> 'churn_label' THEN CASE WHEN sqrt(round_even(r_valid * c_valid / (r_valid + c_valid), 0)) * d < 0.2e0 THEN 1 ELSE
      least(greatest(2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END
        * exp(-2e0 * k * k * round_even(r_valid * c_valid / (r_valid + c_valid), 0) * d * d))), 0), 1) END END AS secondary_pvalue,
    1 - r_valid / r_rows AS reference_missing_rate, 1 - c_valid / c_rows AS comparison_missing_rate,
    CASE WHEN p.feature = 'churn_label' THEN 0 ELSE abs(r_valid / r_rows - c_valid / c_rows) END AS missing_rate_delta,
    r_mean AS reference_mean, c_mean AS comparison_mean, '' AS reference_top_value, '' AS comparison_top_value
  FROM num_pairs p LEFT JOIN bin_psi b USING (ref, cmp, feature) LEFT JOIN single_psi s USING (ref, cmp, feature) LEFT JOIN ks USING (ref, cmp, feature)),
cat_counts AS (SELECT feature, split_name, value, CAST(count(*) AS DOUBLE) AS n FROM cat GROUP BY ALL),
cat_top AS (SELECT feature, split_name, value FROM cat_counts QUALIFY row_number() OVER (PARTITION BY feature, split_name ORDER BY n DESC, value) = 1),
cat_single AS (SELECT ref, cmp, feature, value, any_value(rr.n) AS r_rows, any_value(cc.n) AS c_rows,
    sum(CASE WHEN k.split_name = ref THEN k.n ELSE 0 END) / any_value(rr.n) AS p, sum(CASE WHEN k.split_name = cmp THEN k.n ELSE 0 END) / any_value(cc.n) AS q
  FROM pairs JOIN cat_counts k ON k.split_name IN (ref, cmp) JOIN rows_of rr ON rr.split_name = ref JOIN rows_of cc ON cc.split_name = cmp
  GROUP BY ref, cmp, feature, value),
cat_rows AS (
  SELECT s.ref, s.cmp, s.feature, 'categorical' AS feature_type, sum({_psi('p', 'q')}) AS psi, 'jensen_shannon_distance' AS secondary_metric_name,
    sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END), 0) / 2) AS secondary_metric,
    CAST(NULL AS DOUBLE) AS secondary_pvalue, 0e0 AS reference_missing_rate, 0e0 AS comparison_missing_rate, 0e0 AS missing_rate_delta,
    CAST(NULL AS DOUBLE) AS reference_mean, CAST(NULL AS DOUBLE) AS comparison_mean, any_value(a.value) AS reference_top_value, any_value(b.value) AS comparison_top_value
  FROM cat_single s JOIN cat_top a ON a.feature = s.feature AND a.split_name = ref JOIN cat_top b ON b.feature = s.feature AND b.split_name = cmp
  GROUP BY s.ref, s.cmp, s.feature),
report AS (
  SELECT *, CASE severity WHEN 'high' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END AS severity_rank FROM (
    SELECT ref AS reference_split, cmp AS comparison_split, * EXCLUDE (ref, cmp), ref = 'train' AS is_reference_comparison,
      CASE WHEN psi >= 0.25e0 OR secondary_metric >= 0.2e0 OR missing_rate_delta >= 0.15e0 THEN 'high'
        WHEN psi >= 0.1e0 OR secondary_metric >= 0.1e0 OR missing_rate_delta >= 0.05e0 THEN 'moderate' ELSE 'stable' END AS severity
    FROM (SELECT * FROM num_rows UNION ALL SELECT * FROM cat_rows)))
"""
_D = 7
_DIGITS = {c: _D for c in (
    "psi", "secondary_metric", "secondary_pvalue", "reference_missing_rate", "comparison_missing_rate", "missing_rate_delta",
    "reference_mean", "comparison_mean",
)}


def _rounded(columns: str) -> str:
    return ", ".join(f"round({c}, {_D}) + 0 AS {c}" if c in _DIGITS else c for c in columns.split())


_ALL = (
    "reference_split comparison_split feature feature_type psi secondary_metric_name secondary_metric secondary_pvalue reference_missing_rate "
    "comparison_missing_rate missing_rate_delta reference_mean comparison_mean reference_top_value comparison_top_value severity severity_rank "
    "is_reference_comparison"
)


def _report(t: Tables):
    return t._stored("drift_report", lambda: drift.analyze(t.engineered))


def _g(key: str, build, select: str) -> None:
    register(key, build, f"WITH {_DRIFT_VIEWS.strip()}\n{select}", _DIGITS)


def _saved_report(t: Tables):
    """The whole drift report saved as CSV and read back with its schema; an absent report adds nothing."""
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/holdfast-{uuid.uuid4().hex}"
    sinks.write_csv(_report(t).select(*DRIFT_REPORT_SCHEMA.names), path)
    return reports.read_drift_report(t.spark, path).unionByName(reports.read_drift_report(t.spark, f"{path}-absent"))


# A file has no empty text beside null.
_g("a07_saved_reports", _saved_report, f"SELECT * REPLACE (nullif(reference_top_value, '') AS reference_top_value, nullif(comparison_top_value, '') AS comparison_top_value) FROM (SELECT {_rounded(_ALL)} FROM report)")
_g("g01_split_pairs", lambda t: _report(t).groupBy("reference_split", "comparison_split", "is_reference_comparison").agg(
    F.count_distinct("feature").alias("features")
), "SELECT reference_split, comparison_split, is_reference_comparison, count(*) AS features FROM report GROUP BY ALL")
for key, kind, columns in (
    ("g02_numeric_psi", "numeric", "reference_split comparison_split feature psi"),
    ("g05_ks_distance", "numeric", "reference_split comparison_split feature secondary_metric"),
    ("g06_ks_pvalue", "numeric", "reference_split comparison_split feature secondary_pvalue"),
    ("g04_categorical_psi", "categorical", "reference_split comparison_split feature psi"),
    ("g07_jensen_shannon", "categorical", "reference_split comparison_split feature secondary_metric"),
    ("g10_target_drift", "target", "reference_split comparison_split feature psi secondary_metric reference_mean comparison_mean severity"),
):
    _g(key, lambda t, k=kind, c=columns.split(): _report(t).filter(F.col("feature_type") == k).select(*c),
       f"SELECT {_rounded(columns)} FROM report WHERE feature_type = '{kind}'")
_g("g03_few_edges_psi", lambda t: drift.analyze(
    t.engineered, ["churn_label", "observation_quarter", "retention_offer_count_12m", "unresolved_case_count_12m"], [], None
).select("reference_split", "comparison_split", "feature", "psi"), f"""
SELECT ref AS reference_split, cmp AS comparison_split, feature, round(CASE WHEN len(edges) >= 3 THEN b.psi ELSE s.psi END, {_D}) + 0 AS psi
FROM num_pairs JOIN bin_psi b USING (ref, cmp, feature) JOIN single_psi s USING (ref, cmp, feature)
WHERE feature IN ('churn_label', 'observation_quarter', 'retention_offer_count_12m', 'unresolved_case_count_12m')""")
_g("g08_missing_rates", lambda t: _report(t).select("reference_split", "comparison_split", "feature", "reference_missing_rate", "comparison_missing_rate", "missing_rate_delta"),
   f"SELECT {_rounded('reference_split comparison_split feature reference_missing_rate comparison_missing_rate missing_rate_delta')} FROM report")
_g("g09_means_and_tops", lambda t: _report(t).select("reference_split", "comparison_split", "feature", "reference_mean", "comparison_mean", "reference_top_value", "comparison_top_value"),
   f"SELECT {_rounded('reference_split comparison_split feature reference_mean comparison_mean reference_top_value comparison_top_value')} FROM report")
_g("g11_severity", lambda t: _report(t).groupBy("is_reference_comparison", "severity", "severity_rank").agg(F.count(F.lit(1)).alias("rows")),
   "SELECT is_reference_comparison, severity, severity_rank, count(*) AS rows FROM report GROUP BY ALL")
_g("g12_drift_report", lambda t: drift.analyze(t.engineered), f"SELECT {_rounded(_ALL)} FROM report")
_g("g13_summary_counts", lambda t: drift.summary_counts(_report(t)), """
SELECT (SELECT count(*) FROM (SELECT DISTINCT reference_split, comparison_split FROM report)) AS total_comparisons, count(*) AS total_features,
  count(*) FILTER (r = 3) AS high_drift_features, count(*) FILTER (r = 2) AS moderate_drift_features, count(*) FILTER (r = 1) AS stable_features
FROM (SELECT feature, max(severity_rank) AS r FROM report WHERE is_reference_comparison GROUP BY feature)""")
_g("g13_top_drift", lambda t: drift.top_drift(_report(t), 15), f"""
SELECT {_rounded('reference_split comparison_split feature feature_type psi secondary_metric missing_rate_delta severity')} FROM (
  SELECT * FROM report WHERE is_reference_comparison ORDER BY severity_rank DESC, round(psi, 12) DESC, feature, comparison_split LIMIT 15)""")
_g("g14_dashboard_rows", lambda t: drift.dashboard_rows(_report(t), "high").unionByName(drift.dashboard_rows(_report(t), "moderate")), f"""
SELECT {_rounded(_ALL)} FROM (SELECT * FROM report WHERE is_reference_comparison AND severity <> 'stable'
  QUALIFY row_number() OVER (PARTITION BY severity ORDER BY psi DESC, feature, comparison_split) <= 30)""")

# --- H: selection --------------------------------------------------------------------------------


def _contract(t: Tables):
    return selection.feature_contract(t.spark, t.panel.columns)


_FEATURES = [(c, "numeric") for c in NUMERIC_FEATURES] + [(c, "categorical") for c in CATEGORICAL_FEATURES]
_ENGINEERED = set(ENGINEERED_NUMERIC + ENGINEERED_CATEGORICAL)
_CONTRACT_SQL = "contract(position, feature, feature_type, is_engineered, inputs) AS (VALUES " + ", ".join(
    f"({i}, '{c}', '{k}', {str(c in _ENGINEERED).lower()}, [" + ", ".join(f"'{x}'" for x in FEATURE_INPUTS.get(c, ())) + "]::VARCHAR[])"
    for i, (c, k) in enumerate(_FEATURES)
) + ")"
_PROTECTED = ", ".join(f"'{c}'" for c in PROTECTED_COLUMNS)
_SELECTION_SQL = f"""{_CONTRACT_SQL},
gone AS (SELECT DISTINCT feature FROM report WHERE reference_split = 'train' AND severity = 'high' UNION SELECT '{ALWAYS_EXCLUDED[0]}'),
flags AS (SELECT c.*, feature IN (SELECT feature FROM gone) AS drifted,
  feature IN (SELECT feature FROM gone) AND NOT is_engineered AND feature NOT IN ({_PROTECTED}) AS drop_raw FROM contract c),
selected AS (SELECT position, feature, feature_type, is_engineered, drifted, drop_raw,
  coalesce(list_has_any(inputs, (SELECT list(feature) FROM flags WHERE drop_raw)), false) AS input_dropped FROM flags),
final AS (SELECT *, drifted OR input_dropped AS removed, NOT (drifted OR input_dropped) AS selected FROM selected)
"""


def _selection(t: Tables):
    return selection.select_features(_report(t), _contract(t))


register("h01_feature_selection", _selection, f"WITH {_DRIFT_VIEWS.strip()}, {_SELECTION_SQL} SELECT * FROM final")
register("h01_selection_summary", lambda t: selection.selection_summary(_selection(t)).drop("protected_columns"), f"""
WITH {_DRIFT_VIEWS.strip()}, {_SELECTION_SQL}
SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (removed), '') AS features_to_remove,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (drop_raw), '') AS raw_columns_to_drop,
  coalesce(string_agg(feature, ',' ORDER BY position) FILTER (selected AND feature_type = 'numeric'), '') AS selected_numeric_features,
  coalesce(string_agg(feature, ',' ORDER BY position) FILTER (selected AND feature_type = 'categorical'), '') AS selected_categorical_features,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (removed AND is_engineered), '') AS excluded_engineered_features,
  coalesce(string_agg(feature, ',' ORDER BY position) FILTER (selected), '') AS selected_feature_columns FROM final""")
_REASON = "feature feature_type reference_split comparison_split psi secondary_metric_name secondary_metric missing_rate_delta severity"
register("h05_removal_reasons", lambda t: selection.removal_reasons(_report(t), _selection(t)), f"""
WITH {_DRIFT_VIEWS.strip()}, {_SELECTION_SQL}
SELECT {_rounded(_REASON)} FROM report WHERE is_reference_comparison AND feature IN (SELECT feature FROM final WHERE drifted)""", _DIGITS)
register("c15_rows_of_features", lambda t: marts.rows_of_features(_report(t), _selection(t).filter("removed")).select("feature", "comparison_split", "reference_split", "severity"), f"""
WITH {_DRIFT_VIEWS.strip()}, {_SELECTION_SQL}
SELECT feature, comparison_split, reference_split, severity FROM report WHERE feature IN (SELECT feature FROM final WHERE removed)""")

# --- J: metrics ----------------------------------------------------------------------------------

_CELLS = f"""cells AS (SELECT split_name, count(*) FILTER (label = 0 AND score < {THRESHOLD}e0) AS tn, count(*) FILTER (label = 0 AND score >= {THRESHOLD}e0) AS fp,
  count(*) FILTER (label = 1 AND score < {THRESHOLD}e0) AS fn, count(*) FILTER (label = 1 AND score >= {THRESHOLD}e0) AS tp FROM scores GROUP BY split_name)"""
_J = 9
_J01 = f"""round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), {_J}) AS accuracy, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), {_J}) AS precision,
  round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), {_J}) AS recall, round(coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0), {_J}) AS f1"""
_RANKED = """by_score AS (SELECT split_name, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scores GROUP BY ALL),
swept AS (SELECT *, sum(pos) OVER (PARTITION BY split_name ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY split_name ORDER BY score DESC) AS fp,
  sum(pos) OVER (PARTITION BY split_name) AS p, sum(neg) OVER (PARTITION BY split_name) AS n,
  sum(neg) OVER (PARTITION BY split_name ORDER BY score) - neg AS neg_below FROM by_score)"""
_AP = f"round(sum(CAST(pos AS DOUBLE) / p * (CAST(tp AS DOUBLE) / (tp + fp))), {_J}) AS average_precision"
_AUC = f"round(sum(pos * (neg_below + neg / 2e0)) / (CAST(max(p) AS DOUBLE) * max(n)), {_J}) AS auc"
register("j01_threshold_metrics", lambda t: metrics.threshold_metrics(t.scores, THRESHOLD), f"WITH {_CELLS} SELECT split_name, {_J01} FROM cells", _J)
register("j02_average_precision", lambda t: metrics.ranking_metrics(t.scores).select("split_name", "average_precision"),
         f"WITH {_RANKED} SELECT split_name, {_AP} FROM swept GROUP BY split_name", _J)
register("j03_roc_auc", lambda t: metrics.ranking_metrics(t.scores).select("split_name", "auc"), f"WITH {_RANKED} SELECT split_name, {_AUC} FROM swept GROUP BY split_name", _J)
_LONG = """long AS (SELECT split_name, 0 AS actual_label, 0 AS predicted_label, tn AS rows FROM cells UNION ALL SELECT split_name, 0, 1, fp FROM cells
  UNION ALL SELECT split_name, 1, 0, fn FROM cells UNION ALL SELECT split_name, 1, 1, tp FROM cells)"""
register("j04_confusion_cells", lambda t: metrics.confusion_cells(t.scores, THRESHOLD), f"WITH {_CELLS}, {_LONG} SELECT * FROM long")
register("j05_confusion_shares", lambda t: metrics.confusion_shares(metrics.confusion_cells(t.scores, THRESHOLD)), f"""
WITH {_CELLS}, {_LONG}
SELECT l.*, round(CAST(rows AS DOUBLE) / greatest(CASE actual_label WHEN 0 THEN tn + fp ELSE fn + tp END, 1), {_J}) AS row_share,
  round(CAST(rows AS DOUBLE) / greatest(tn + fp + fn + tp, 1), {_J}) AS total_share, round(CAST(tp AS DOUBLE) / greatest(tp + fp, 1), {_J}) AS precision,
  round(CAST(tp AS DOUBLE) / greatest(tp + fn, 1), {_J}) AS recall FROM long l JOIN cells USING (split_name)""", _J)
_GRID = f"""cuts AS (SELECT round(0.02e0 + 0.04e0 * i, 3) AS threshold FROM range(10) r(i)),
grid0 AS (SELECT split_name, threshold, count(*) FILTER (label = 0 AND score < threshold) AS tn, count(*) FILTER (label = 0 AND score >= threshold) AS fp,
  count(*) FILTER (label = 1 AND score < threshold) AS fn, count(*) FILTER (label = 1 AND score >= threshold) AS tp FROM scores CROSS JOIN cuts GROUP BY ALL),
rates AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS pr, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS rc FROM grid0),
grid1 AS (SELECT split_name, threshold, tn AS true_non_churn, fp AS false_alarms, fn AS churn_missed, tp AS churn_detected, {ev('pr', 3)} AS precision, {ev('rc', 3)} AS recall,
  {ev('coalesce(2 * pr * rc / nullif(pr + rc, 0), 0)', 3)} AS f1, {ev('coalesce(5 * pr * rc / nullif(4 * pr + rc, 0), 0)', 3)} AS f2,
  {ev('CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp)', 3)} AS alert_rate, {ev('CAST(tp + fn AS DOUBLE) / (tn + fp + fn + tp)', 3)} AS true_positive_rate FROM rates)"""
register("j06_threshold_grid", lambda t: metrics.threshold_grid(t.scores, keys=["split_name"]), f"WITH {_GRID} SELECT * FROM grid1")
register("j07_best_threshold", lambda t: metrics.best_threshold(metrics.threshold_grid(t.scores, keys=["split_name"]), keys=["split_name"]), f"""
WITH {_GRID} SELECT split_name, threshold, f2, recall, precision FROM grid1
QUALIFY row_number() OVER (PARTITION BY split_name ORDER BY f2 DESC, recall DESC, precision DESC, threshold) = 1""")
register("j08_score_distribution", lambda t: metrics.score_distribution(t.scores, THRESHOLD), f"""
SELECT split_name, count(*) AS rows, min(score) AS min, round(quantile_cont(score, 0.5), {_J}) AS p50, round(quantile_cont(score, 0.9), {_J}) AS p90,
  round(quantile_cont(score, 0.95), {_J}) AS p95, round(quantile_cont(score, 0.99), {_J}) AS p99, max(score) AS max,
  count(*) FILTER (score >= {THRESHOLD}e0) AS predicted_positives FROM scores GROUP BY split_name""", {c: _J for c in ("p50", "p90", "p95", "p99")})
register("j09_split_summary", lambda t: metrics.split_summary(t.labels), f"""
SELECT split_name, count(*) AS rows, round(avg(churn_label), {_J}) AS churn_rate, CAST(min(observation_date) AS VARCHAR) AS min_time,
  CAST(max(observation_date) AS VARCHAR) AS max_time FROM lab GROUP BY split_name""", _J)
register("j10_metrics_by_split", lambda t: metrics.evaluate(t.scores, THRESHOLD), f"""
WITH {_CELLS}, {_RANKED}, r AS (SELECT split_name, {_AP}, {_AUC} FROM swept GROUP BY split_name)
SELECT split_name, {_J01}, average_precision, auc FROM cells JOIN r USING (split_name)""", _J)
register("j11_top_k", lambda t: metrics.top_k_metrics(t.scores, (10, 100, 1000), ("customer_id", "observation_date")), f"""
WITH placed AS (SELECT *, row_number() OVER (PARTITION BY split_name ORDER BY score DESC, customer_id, observation_date) AS place FROM scores),
per AS (SELECT split_name, k, count(*) FILTER (label = 1 AND place <= k) AS hits, count(*) AS n, sum(label) AS p FROM placed CROSS JOIN (VALUES (10), (100), (1000)) v(k) GROUP BY ALL)
SELECT split_name, k, hits, round(CAST(hits AS DOUBLE) / least(k, n), {_J}) AS precision_at_k, round(CAST(hits AS DOUBLE) / p, {_J}) AS recall_at_k,
  round(CAST(hits AS DOUBLE) / least(k, n) / (CAST(p AS DOUBLE) / n), {_J}) AS lift_at_k FROM per""", _J)
