"""Boosting on histograms: the trees of Spark ML's booster, grown once and no further than the stop, from any number of tasks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.operators import boosting, model, preprocess
from holdfast.operators.model import TrainingConfig

NUMERIC, CATEGORICAL = ["tenure_months", "complaints_6m", "loyalty_score", "total_annual_premium"], ["customer_segment", "region"]
CONFIG = TrainingConfig(iterations=30, patience=4, min_rows_per_leaf=5, depth=3)


@pytest.fixture(scope="module")
def prepared(tables):
    fills = preprocess.FillValues(NUMERIC, CATEGORICAL).fit(tables.panel.filter("split_name = 'train'"))
    return fills.transform(tables.panel).cache()


@pytest.fixture(scope="module")
def boosted(prepared):
    return model.boost(prepared, NUMERIC, CATEGORICAL, CONFIG)


def test_no_tree_is_grown_after_the_stop(boosted):
    assert len(boosted.grown.trees) == len(boosted.trees) == boosted.stopped < CONFIG.iterations


def test_trees_are_those_of_spark_ml(boosted, prepared):
    features = PipelineModel(stages=boosted.model.stages[:-1]).transform(prepared)
    bins = model.bins_for(prepared, CATEGORICAL)
    own = model.booster(CONFIG, bins, boosted.stopped).fit(features.filter("split_name = 'train'").coalesce(1))
    margin = F.element_at(vector_to_array("rawPrediction"), 2)
    columns = ["customer_id", "observation_date", margin.alias("m")]
    both = own.transform(features).select(*columns).join(boosted.grown.transform(features).select(*columns[:2], margin.alias("n")), columns[:2])
    assert both.agg(F.max(F.abs(F.col("m") - F.col("n")))).first()[0] < 1e-9
    assert own.treeWeights == boosted.grown.treeWeights and own.getNumTrees == boosted.grown.getNumTrees


def test_a_job_for_each_level_finds_the_same_metrics(boosted, prepared, monkeypatch):
    monkeypatch.setattr(model, "SMALL_ROWS", 0)
    monkeypatch.setattr(model, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 2)
    spread = model.boost(prepared, NUMERIC, CATEGORICAL, CONFIG)
    assert [m[0] for m in spread.validation][:2] == [1, 2]
    assert [m[1:] for m in spread.validation][:2] == [pytest.approx(m[1:]) for m in boosted.validation[:2]]
    assert len(spread.trees) == spread.stopped


def test_features_counted_together_have_the_same_histograms_and_leaves(monkeypatch):
    monkeypatch.setattr(boosting, "SINGLE_ROWS", 0)
    rng = np.random.default_rng(3)
    space = boosting.Space((np.arange(4.0), np.arange(2.0), None, np.arange(6.0)), (0, 0, 3, 0))
    bins = np.stack([rng.integers(0, k, 5000) for k in space.bins], 1).astype(np.uint8)
    labels, train = (rng.random(5000) < 0.4 + 0.1 * (bins[:, 1] == 2)).astype(float), rng.random(5000) < 0.7
    joint = boosting.Rows(space, bins, labels, train)
    single = boosting.Rows(space, bins, labels, train)
    single.groups = [[f] for f in range(4)]
    single.codes = np.ascontiguousarray(bins[np.argsort(~train, kind="stable")].T)
    assert len(joint.groups) < 4
    g, slots = rng.random(joint.train), rng.integers(-1, 3, joint.train)
    assert np.allclose(joint.histograms(slots, 3, g), single.histograms(slots, 3, g))
    trees = []
    for rows in (joint, single):
        growing = boosting._tree(space, boosting.Plan(1, 0.1, 3, 20, 4, 1, 1), 1)
        tree, nodes = next(growing)
        while True:
            places = np.full(len(tree.feature), -1)
            places[nodes] = np.arange(len(nodes))
            sums = rows.histograms(places[rows.placed(tree, rows.train)], len(nodes), np.where(rows.labels[: rows.train] == 1, 1.0, -1.0))
            real = np.arange(space.bins.max()) < space.bins[:, None]
            try:
                tree, nodes = growing.send([(sums[0][:, real], sums[1:, :, real])])
            except StopIteration as end:
                trees.append((rows.placed(end.value, rows.n), end.value))
                break
    assert trees[0][1].depth > 1 and np.array_equal(trees[0][0], trees[1][0]) and np.array_equal(trees[0][1].feature, trees[1][1].feature)


def test_labels_that_are_none_are_refused(prepared):
    with pytest.raises(ValueError, match="0 or 1"):
        model.boost(prepared.withColumn("churn_label", F.lit(None).cast("int")), NUMERIC, CATEGORICAL, CONFIG)
