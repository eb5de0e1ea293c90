"""Boosting with patience: margins, metrics after each tree, the kept prefix, and the grid's number of fits."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.operators import model, preprocess
from holdfast.operators.model import TrainingConfig, patient_stop

NUMERIC, CATEGORICAL = ["tenure_months", "complaints_6m", "loyalty_score", "total_annual_premium"], ["customer_segment", "region"]
CONFIG = TrainingConfig(iterations=30, patience=6, min_rows_per_leaf=5, depth=3)


@pytest.fixture(scope="module")
def prepared(tables):
    fills = preprocess.FillValues(NUMERIC, CATEGORICAL).fit(tables.panel.filter("split_name = 'train'"))
    return fills.transform(tables.panel).cache()


@pytest.fixture(scope="module")
def boosted(prepared):
    return model.boost(prepared, NUMERIC, CATEGORICAL, CONFIG)


def _margins(boosted, prepared, split):
    features = PipelineModel(stages=boosted.model.stages[:-1]).transform(prepared.filter(F.col("split_name") == split))
    return model.staged_margins(boosted.grown, features.withColumnRenamed("churn_label", "label"))


@pytest.mark.parametrize(("values", "patience", "expected"), [
    ([0.5], 3, (1, None)), ([0.5, 0.6, 0.6, 0.55, 0.5], 3, (2, 5)), ([0.5, 0.4, 0.4, 0.4, 0.9], 3, (1, 4)), ([0.1, 0.2, 0.3], 1, (3, None)), ([], 3, (1, None)),
])
def test_patient_stop(values, patience, expected):
    assert patient_stop(values, patience) == expected


def test_margins_end_in_the_model_s_own_and_prefixes_agree(boosted, prepared):
    rows = _margins(boosted, prepared, "validation")
    n = len(boosted.grown.trees)
    for size in (n, boosted.best):
        kept = model.first_trees(boosted.grown, size)
        own = F.element_at(vector_to_array("rawPrediction"), 2)
        gap = kept.transform(rows).agg(F.max(F.abs(own - F.element_at("margins", size))).alias("gap")).first().gap
        assert gap < 1e-9
    assert len(boosted.model.stages[-1].trees) == boosted.best


def test_metrics_of_every_tree_match_sql_over_stored_margins(boosted, prepared, tmp_path):
    _margins(boosted, prepared, "validation").select("label", F.posexplode("margins").alias("step", "m")).write.parquet(str(tmp_path / "margins"))
    expected = duckdb.sql(f"""
        WITH r AS (SELECT step + 1 AS iteration, label, m, round(m, 4) AS t FROM '{tmp_path}/margins/*.parquet')
        SELECT a.iteration, (SELECT avg(CASE WHEN p.t > n.t THEN 1.0 WHEN p.t = n.t THEN 0.5 ELSE 0 END) FROM r p, r n
            WHERE p.iteration = a.iteration AND n.iteration = a.iteration AND p.label = 1 AND n.label = 0) AS auc,
          (SELECT avg(ln(1 + exp(CASE label WHEN 1 THEN -2 * m ELSE 2 * m END))) FROM r WHERE iteration = a.iteration) AS logloss
        FROM (SELECT DISTINCT iteration FROM r) a ORDER BY iteration""").fetchall()
    measured = model.staged_metrics(_margins(boosted, prepared, "validation"), "split_name").orderBy("iteration").collect()
    assert [r.iteration for r in measured] == [e[0] for e in expected]
    assert all(math.isclose(r.auc, a, abs_tol=1e-9) and math.isclose(r.logloss, x, abs_tol=1e-9) for r, (_, a, x) in zip(measured, expected, strict=True))
    aucs = [e[1] for e in expected]
    best, stop = patient_stop(aucs, CONFIG.patience)
    assert (boosted.best, boosted.stopped) == (best, stop or len(aucs))
    assert [m[1] for m in boosted.validation] == pytest.approx(aucs[: boosted.stopped])


def test_curve_and_diagnostics(boosted, prepared):
    parts = {"learn": prepared.filter("split_name = 'train'"), "validation": prepared.filter("split_name = 'validation'")}
    curve = model.training_curve(boosted, parts)
    rows = curve.collect()
    assert len(rows) == boosted.stopped * 4 and {(r.dataset, r.metric) for r in rows} == {(d, m) for d in parts for m in ("Logloss", "AUC")}
    found = model.training_diagnostics(curve).first()
    losses = {(r.dataset, r.iteration): r.value for r in rows if r.metric == "Logloss"}
    held = [losses["validation", i] for i in range(1, boosted.stopped + 1)]
    assert found.best_validation_iteration == held.index(min(held)) + 1 and found.final_iteration == boosted.stopped
    assert found.final_logloss_gap_validation_minus_train == pytest.approx(held[-1] - losses["learn", boosted.stopped])


def test_grid_has_one_fit_per_rate_and_depth(prepared, monkeypatch):
    fits, real = [], model.booster

    def counted(config, bins, iterations):
        fits.append((config.learning_rate, config.depth, iterations))
        return real(config, bins, iterations)

    monkeypatch.setattr(model, "booster", counted)
    grid = {"iterations": (2, 3, 5), "learning_rate": (0.03, 0.05, 0.08), "depth": (1, 2, 3)}
    best, results = model.grid_search(prepared, NUMERIC, CATEGORICAL, CONFIG, grid)
    assert len(results) == 27 and sorted(fits) == sorted((r, d, 5) for r in grid["learning_rate"] for d in grid["depth"])
    top = max(auc for _, auc in results)
    scored = model.staged_metrics(
        model.staged_margins(best.stages[-1], PipelineModel(stages=best.stages[:-1]).transform(prepared.filter("split_name = 'validation'")).withColumnRenamed("churn_label", "label")),
        "split_name",
    ).orderBy("iteration").collect()
    assert scored[-1].auc == pytest.approx(top)


def test_saved_prefix_scores_the_same(boosted, prepared, tmp_path):
    boosted.model.write().save(str(tmp_path / "model"))
    rows = prepared.filter("split_name = 'test'")
    again = model.score(PipelineModel.load(str(tmp_path / "model")), rows)
    assert again.exceptAll(model.score(boosted.model, rows)).count() == 0


def test_no_validation_rows_keep_one_tree(prepared):
    alone = model.boost(prepared.filter("split_name = 'train'"), NUMERIC, CATEGORICAL, TrainingConfig(iterations=3, patience=2, depth=2))
    assert (alone.best, alone.validation) == (1, [])
