"""The linear baseline's contributions reproduce its margins."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.operators import explain, model, preprocess


def test_linear_contributions_reproduce_the_margin(tables):
    numeric, categorical = ["tenure_months", "complaints_6m", "loyalty_score"], ["region", "customer_segment"]
    train = preprocess.FillValues(numeric, categorical).fit(tables.panel).transform(tables.panel).filter("split_name = 'train'")
    fitted = model.logistic_pipeline(numeric, categorical, 20).fit(train)
    weights, levels = model.linear_weights(fitted, numeric), model.level_weights(fitted, numeric, categorical)
    assert set(levels["region"]) == {r.region for r in train.select("region").distinct().collect()}
    means = explain.feature_means(train, numeric, levels)
    parts = explain.linear_contributions(train, weights, means, ["observation_date", "customer_id"], levels)
    base = sum(weights[f] * means[f] for f in numeric) + sum(means[f] for f in categorical) + float(fitted.stages[-1].intercept)
    margin = fitted.transform(train).select("observation_date", "customer_id", F.element_at(vector_to_array("rawPrediction"), 2).alias("margin"))
    total = sum((F.col(f) for f in numeric + categorical), F.lit(base))
    gap = parts.join(margin, ["observation_date", "customer_id"]).agg(F.max(F.abs(total - F.col("margin"))).alias("gap")).first().gap
    assert gap < 1e-9


def test_grid_search_picks_the_best_validation_auc(tables):
    numeric, categorical = ["tenure_months", "complaints_6m"], ["customer_segment"]
    fills = preprocess.FillValues(numeric, categorical).fit(tables.panel.filter("split_name = 'train'"))
    grid = {"iterations": (2,), "learning_rate": (0.05,), "depth": (1, 2)}
    best, results = model.grid_search(fills.transform(tables.panel), numeric, categorical, model.TrainingConfig(min_rows_per_leaf=5), grid)
    assert len(results) == 2 and all(0.0 <= auc <= 1.0 for _, auc in results)
    depth = max(results, key=lambda r: r[1])[0]["maxDepth"]
    assert best.stages[-1].getOrDefault("maxDepth") == depth
