"""Churn model training and scoring with Spark ML."""

from __future__ import annotations

import math
import pickle
import re
from array import array
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import even_round
from holdfast.operators import boosting
from holdfast.operators.boosting import patient_stop
from holdfast.operators.lifecycle import prediction_band
from holdfast.schemas import CATEGORICAL_FEATURES, ID_COLUMNS, NUMERIC_FEATURES, SPLIT_COLUMN, TARGET_COLUMN
from holdfast.session import ensure_checkpoint_dir, materialize


@dataclass(frozen=True)
class TrainingConfig:
    """Model size, decision threshold and names."""

    iterations: int = 500
    learning_rate: float = 0.05
    depth: int = 4
    min_rows_per_leaf: int = 50
    feature_share: float = 0.8
    seed: int = 42
    patience: int = 50
    threshold: float = 0.14
    model_name: str = "churn_gbt"


#: Up to so many rows of training, some 6 MB when binned, are boosted in one task; a level of more is a job.
SMALL_ROWS = 100_000
#: Rows that make a task of their own worth its start in boosting.
ROWS_PER_TASK = 20_000
#: Rows of training that a task holds at most, with their share of the others.
MOST_ROWS_PER_TASK = 500_000
#: Margins that agree to so many decimals are ties of the AUC.
TIE_DIGITS = 4

# The search space.
GRID = {"iterations": (200, 300, 500), "learning_rate": (0.03, 0.05, 0.08), "depth": (4, 6, 8)}


def _features(numeric: Sequence[str], categorical: Sequence[str], one_hot: bool) -> list:
    indexed, encoded = [f"{c}__index" for c in categorical], [f"{c}__hot" for c in categorical]
    stages: list = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        if one_hot:
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
    inputs = list(numeric) + (encoded if one_hot else indexed)
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error")]


def booster(config: TrainingConfig = TrainingConfig(), max_bins: int = 32, iterations: int | None = None) -> GBTClassifier:
    """Boosted trees over assembled features. ``max_bins`` must exceed the largest category count.

    The seed of a tree depends on its place alone, so an ensemble is a prefix of every larger one.
    """
    return GBTClassifier(
        labelCol=TARGET_COLUMN, featuresCol="features", maxIter=iterations or config.iterations, stepSize=config.learning_rate,
        maxDepth=config.depth, minInstancesPerNode=config.min_rows_per_leaf, seed=config.seed, maxBins=max_bins,
        featureSubsetStrategy=str(config.feature_share), checkpointInterval=10,
    )


def logistic_pipeline(numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES, max_iter: int = 50) -> Pipeline:
    """Linear baseline whose contributions are exact (see ``explain``)."""
    linear = LogisticRegression(labelCol=TARGET_COLUMN, featuresCol="features", maxIter=max_iter, regParam=0.01)
    return Pipeline(stages=[*_features(numeric, categorical, one_hot=True), linear])


def bins_for(rows: DataFrame, categorical: Sequence[str]) -> int:
    """Enough bins for the category with the most levels, one more for unseen ones; 32 at least."""
    if not categorical:
        return 32
    levels = rows.agg(*[F.count_distinct(c).alias(c) for c in categorical]).first()
    return max(32, max(levels) + 2)


_PREDICT = re.compile(r"Predict: (\S+)")


def leaf_values(trees: GBTClassificationModel) -> np.ndarray:
    """What each leaf adds to the margin, one row per tree; leaves are numbered from left to right."""
    parts = re.split(r"(?m)^\s*Tree \d+ \(weight ([^)]*)\):$", trees.toDebugString)[1:]
    weights, bodies = map(float, parts[::2]), parts[1::2]
    rows = [[w * float(v) for v in _PREDICT.findall(body)] for w, body in zip(weights, bodies, strict=True)]
    table = np.zeros((len(rows), max(map(len, rows), default=1)))
    for i, row in enumerate(rows):
        table[i, : len(row)] = row
    return table


def staged_margins(trees: GBTClassificationModel, rows: DataFrame, column: str = "margins") -> DataFrame:
    """Add the margin after each tree, from one pass that finds the leaves of all trees."""
    table = leaf_values(trees)

    @F.pandas_udf("array<double>")
    def running(leaves: pd.Series) -> pd.Series:
        if not len(leaves):
            return pd.Series([], dtype=object)
        found = np.stack(leaves.to_numpy()).astype(np.int64)
        return pd.Series(list(np.cumsum(table[np.arange(len(table)), found], axis=1)))

    placed = trees.copy().setLeafCol("_leaves").transform(rows)
    return placed.withColumn(column, running(vector_to_array("_leaves"))).select(*rows.columns, column)


def staged_metrics(rows: DataFrame, by: str, label: str = "label", margins: str = "margins", digits: int = TIE_DIGITS) -> DataFrame:
    """(by, iteration, auc, logloss) after each tree.

    Margins that agree to ``digits`` decimals count as ties of the AUC. So the rows of a group combine to a number that
    the range of the margins bounds, whatever the size of the data; the log loss is of the margins as they are.
    """
    sign = F.when(F.col(label) == 1, F.lit(-2.0)).otherwise(F.lit(2.0))
    steps = rows.select(by, label, sign.alias("_sign"), F.posexplode(margins).alias("_at", "_m"))
    x = F.col("_sign") * F.col("_m")
    loss = F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
    counted = steps.groupBy(by, (F.col("_at") + 1).alias("iteration"), F.round("_m", digits).alias("_m")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("_pos"), F.count(F.when(F.col(label) == 0, 1)).alias("_neg"), F.sum(loss).alias("_loss")
    )
    return _metrics_of(counted, by)


def _metrics_of(counted: DataFrame, by: str) -> DataFrame:
    """(by, iteration, auc, logloss) of counts of the classes and summed losses by margin."""
    before = Window.partitionBy(by, "iteration").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    below = counted.withColumn("_below", F.coalesce(F.sum("_neg").over(before), F.lit(0)))
    wins = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / F.lit(2.0)))
    return below.groupBy(by, "iteration").agg(
        F.coalesce(F.try_divide(wins, F.sum("_pos").cast("double") * F.sum("_neg")), F.lit(0.0)).alias("auc"),
        F.try_divide(F.sum("_loss"), F.sum(F.col("_pos") + F.col("_neg"))).alias("logloss"),
    )


def first_trees(trees: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees, with the same settings."""
    jvm, gateway = trees._java_obj, SparkContext._active_spark_context._gateway
    classes = gateway.jvm.org.apache.spark.ml
    kept = gateway.new_array(classes.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    all_trees, all_weights = jvm.trees(), jvm.treeWeights()
    for i in range(n):
        kept[i], weights[i] = all_trees[i], all_weights[i]
    prefix = GBTClassificationModel(classes.classification.GBTClassificationModel(f"{trees.uid}_{n}", kept, weights))
    return trees._copyValues(prefix)


@dataclass(frozen=True)
class Grown:
    """The trees over binned features up to the iteration that boosting stopped at, and the metrics after each."""

    settings: GBTClassifier
    space: boosting.Space
    trees: list[boosting.Tree]
    metrics: list[tuple[int, float, float]]
    best: int


@dataclass(frozen=True)
class Boosted:
    """A fitted ensemble cut at its best iteration, the number of the iteration it stopped at, and how training went.

    ``grown`` is the ensemble before the cut. ``validation`` is (iteration, auc, logloss) up to the stop.
    """

    model: PipelineModel
    best: int
    stopped: int
    grown: GBTClassificationModel
    validation: list[tuple[int, float, float]]
    space: boosting.Space
    trees: list[boosting.Tree]


def _featured(prepared: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> tuple[PipelineModel, DataFrame, int]:
    """Indexed and assembled rows of train and validation, written once for all fits, and the number of bins."""
    rows = prepared.filter(F.col(SPLIT_COLUMN).isin("train", "validation"))
    stages = Pipeline(stages=_features(numeric, categorical, one_hot=False)).fit(rows)
    slim = stages.transform(rows).select(SPLIT_COLUMN, TARGET_COLUMN, "features")
    return stages, materialize(slim, "assembled"), bins_for(rows, categorical)


def _space(stages: PipelineModel, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int, n: int, seed: int) -> boosting.Space:
    """The bins of every feature; thresholds come from a sample of bounded size, of all rows while they are fewer."""
    levels = [len(labels) + 1 for labels in stages.stages[0].labelsArray] if categorical else []
    most = max(bins * bins, boosting.SAMPLE_ROWS)
    sample = rows if n <= most else rows.sample(most / n, seed)
    values = sample.select(vector_to_array("features").alias("v")).toArrow().column("v").combine_chunks()
    table = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(numeric) + len(levels))
    found = [boosting.thresholds(table[:, i], min(bins, n)) for i in range(len(numeric))]
    return boosting.Space((*found, *[None] * len(levels)), (*[0] * len(numeric), *levels))


def spark_model(settings: GBTClassifier, space: boosting.Space, trees: Sequence[boosting.Tree]) -> GBTClassificationModel:
    """The trees as Spark ML's model. Two leaves of one value are one leaf, as there."""
    gateway = SparkContext._active_spark_context._gateway
    jvm, width = gateway.jvm.org.apache.spark, len(space.levels)
    loads = jvm.ml.python.MLSerDe.loads

    def doubles(values: Sequence[float]) -> object:
        return loads(bytearray(pickle.dumps(array("d", values), protocol=2)))

    def node(tree: boosting.Tree, value: np.ndarray, i: int) -> tuple[object, float | None]:
        stats = jvm.mllib.tree.impurity.VarianceCalculator(doubles(tree.stats[i]), int(tree.stats[i, 0]))
        f, impurity = int(tree.feature[i]), float(tree.impurity[i])
        if f >= 0:
            (left, a), (right, b) = (node(tree, value, int(k)) for k in tree.children[i])
            if a is None or a != b:
                goes = np.flatnonzero(tree.left[i])
                cut = space.thresholds[f]
                split = (
                    jvm.ml.tree.ContinuousSplit(f, float(cut[goes[-1]])) if cut is not None
                    else jvm.ml.tree.CategoricalSplit(f, doubles([float(x) for x in goes if x < space.levels[f]]), space.levels[f])
                )
                return jvm.ml.tree.InternalNode(float(value[i]), impurity, float(tree.gain[i]), left, right, split, stats), None
        return jvm.ml.tree.LeafNode(float(value[i]), impurity, stats), float(value[i])

    made = gateway.new_array(jvm.ml.regression.DecisionTreeRegressionModel, len(trees))
    for i, tree in enumerate(trees):
        made[i] = jvm.ml.regression.DecisionTreeRegressionModel(f"{settings.uid}_{i}", node(tree, tree.value, 0)[0], width)
    weights = doubles([1.0, *[settings.getStepSize()] * (len(trees) - 1)])
    return settings._copyValues(GBTClassificationModel(jvm.ml.classification.GBTClassificationModel(settings.uid, made, weights)))


def _grow(
    stages: PipelineModel, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], configs: Sequence[TrainingConfig], bins: int, most: int = 1,
) -> list[Grown]:
    """One ensemble per configuration, each grown tree by tree until its validation AUC has not risen for ``patience`` trees.

    The binned rows are shared, and ``most`` ensembles grow side by side (see ``boosting``). A level of them is a job. Where the
    rows are so few that a job costs more than the level, an ensemble is grown by one task.
    """
    train = rows.filter(F.col(SPLIT_COLUMN) == "train")
    n, fit_for = train.agg(F.count(F.lit(1)), F.count_if(F.col(TARGET_COLUMN).isin(0, 1))).first()
    if not n or fit_for < n:
        raise ValueError(f"boosting needs train rows whose label is 0 or 1: {fit_for} of {n} are")
    space = _space(stages, train, numeric, categorical, bins, n, configs[0].seed)
    small = n <= SMALL_ROWS
    tasks = 1 if small else max(min(n // ROWS_PER_TASK, rows.sparkSession.sparkContext.defaultParallelism), -(-n // MOST_ROWS_PER_TASK))
    width = len(space.levels)
    settings = [booster(config, bins, config.iterations) for config in configs]
    plans = [
        boosting.Plan(c.iterations, c.learning_rate, c.depth, c.min_rows_per_leaf, max(1, math.ceil(c.feature_share * width)), c.seed, c.patience) for c in configs
    ]
    binned = rows.select(
        (F.col(SPLIT_COLUMN) == "train").alias("train"), F.col(TARGET_COLUMN).cast("double").alias("label"), vector_to_array("features").alias("features")
    ).mapInArrow(boosting.binner(space), boosting.BINNED)
    dealt = binned.repartition(tasks) if tasks > 1 else binned.coalesce(1)
    held = not rows.filter(F.col(SPLIT_COLUMN) == "validation").isEmpty()
    grown, out = boosting.grow(dealt.mapInArrow(boosting.packer(space), boosting.PACKED), space, plans, held, most, TIE_DIGITS, small), []
    for own, config, (trees, metrics) in zip(settings, configs, grown, strict=True):
        out.append(Grown(own, space, trees, metrics, patient_stop([m[1] for m in metrics] or [0.0], config.patience)[0]))
    return out


def boost(
    prepared: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
    config: TrainingConfig = TrainingConfig(),
) -> Boosted:
    """Fit on the train split; stop once the validation AUC has not risen for ``patience`` trees; keep the best prefix.

    An empty validation split has no AUC above 0, so one tree is kept. Lineage is cut in the shared checkpoint folder.
    """
    ensure_checkpoint_dir(prepared.sparkSession)
    stages, rows, bins = _featured(prepared, numeric, categorical)
    (found,) = _grow(stages, rows, numeric, categorical, [config], bins)
    grown = spark_model(found.settings, found.space, found.trees)
    return Boosted(
        PipelineModel(stages=[*stages.stages, first_trees(grown, found.best)]), found.best, len(found.trees), grown, found.metrics, found.space, found.trees
    )


def train_gbt(
    prepared: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
    config: TrainingConfig = TrainingConfig(),
) -> PipelineModel:
    """The model of :func:`boost` alone."""
    return boost(prepared, numeric, categorical, config).model


def grid_search(
    prepared: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
    config: TrainingConfig = TrainingConfig(), grid: dict[str, Sequence] = GRID, parallelism: int = 4,
) -> tuple[PipelineModel, list[tuple[dict[str, float], float]]]:
    """Search over size, rate and depth on the temporal split: fit on train, compare by ROC AUC on validation.

    Returns the best model and every (parameters, AUC). Smaller ensembles are prefixes of larger ones, so each pair of
    rate and depth is grown once, to the largest size or until it stops; a size's AUC is that of its best prefix. The
    features are indexed, assembled and binned once. ``parallelism`` fits run at a time.
    """
    ensure_checkpoint_dir(prepared.sparkSession)
    stages, rows, bins = _featured(prepared, numeric, categorical)
    pairs = [(rate, depth) for rate in grid["learning_rate"] for depth in grid["depth"]]
    configs = [replace(config, learning_rate=rate, depth=depth, iterations=max(grid["iterations"])) for rate, depth in pairs]
    grown = _grow(stages, rows, numeric, categorical, configs, bins, parallelism)
    best, results = None, []
    for iterations in grid["iterations"]:
        for (rate, depth), found in zip(pairs, grown, strict=True):
            held = [m[1] for m in found.metrics[:iterations]] or [0.0]
            at = held.index(max(held))
            results.append(({"maxIter": iterations, "stepSize": rate, "maxDepth": depth}, held[at]))
            if best is None or held[at] > best[2]:
                best = (found, at + 1, held[at])
    model = spark_model(best[0].settings, best[0].space, best[0].trees[: best[1]])
    return PipelineModel(stages=[*stages.stages, model]), results


def positive_probability() -> Column:
    return F.element_at(vector_to_array("probability"), 2)


def score(model: PipelineModel, prepared: DataFrame) -> DataFrame:
    """Keys, label and churn probability; the keys travel with the row, never by position."""
    return model.transform(prepared).select(
        *ID_COLUMNS, SPLIT_COLUMN, F.col(TARGET_COLUMN).alias("label"), positive_probability().alias("score")
    )


def prediction_rows(scores: DataFrame, threshold: float, model_name: str, run_id: str, scored_at: Column | None = None) -> DataFrame:
    """Stored prediction rows: six digits of probability, label by the unrounded one."""
    return scores.select(
        *ID_COLUMNS, SPLIT_COLUMN, even_round("score", 6).alias("churn_probability"),
        (F.col("score") >= threshold).cast("int").alias("predicted_churn_label"),
        prediction_band(F.col("score")).alias("churn_risk_band"),
        F.lit(model_name).alias("model_name"), F.lit(None).cast("string").alias("model_version"),
        F.lit(run_id).alias("mlflow_run_id"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"),
    )


def training_curve(boosted: Boosted, parts: dict[str, DataFrame]) -> DataFrame:
    """(iteration, dataset, metric, value): log loss and AUC after each tree up to the stop, for each named dataset."""
    features, rows = PipelineModel(stages=boosted.model.stages[:-1]), None
    for name, part in parts.items():
        own = features.transform(part).select(F.lit(name).alias("dataset"), F.col(TARGET_COLUMN).cast("double").alias("label"), vector_to_array("features").alias("features"))
        rows = own if rows is None else rows.unionByName(own)
    measure = boosting.measurer(boosted.space, boosted.trees, boosted.grown.getStepSize(), TIE_DIGITS)
    counted = rows.mapInArrow(measure, boosting.TALLIED).groupBy("dataset", "iteration", F.col("step").alias("_m")).agg(
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"), F.sum("loss").alias("_loss")
    )
    measured = _metrics_of(counted, "dataset")
    return measured.unpivot(["iteration", "dataset"], [F.col("logloss").alias("Logloss"), F.col("auc").alias("AUC")], "metric", "value").select(
        F.col("iteration").cast("int").alias("iteration"), "dataset", "metric", "value"
    )


def training_diagnostics(curve: DataFrame) -> DataFrame:
    """Best validation iteration and loss, final losses and their gap, in one row."""
    loss = curve.filter(F.col("metric") == "Logloss").groupBy("iteration").pivot("dataset", ["learn", "validation"]).agg(F.max("value"))
    best = F.min(F.struct("validation", "iteration")).alias("_best")
    last = F.max(F.struct("iteration", "learn", "validation")).alias("_last")
    return loss.agg(best, last).select(
        F.col("_best.iteration").alias("best_validation_iteration"), F.col("_best.validation").alias("best_validation_logloss"),
        F.col("_last.iteration").alias("final_iteration"), F.col("_last.learn").alias("final_train_logloss"),
        F.col("_last.validation").alias("final_validation_logloss"),
        (F.col("_last.validation") - F.col("_last.learn")).alias("final_logloss_gap_validation_minus_train"),
    )


def linear_weights(model: PipelineModel, numeric: Sequence[str]) -> dict[str, float]:
    """Weights of the numeric features of a fitted logistic pipeline (they come first in the vector)."""
    coefficients = model.stages[-1].coefficients.toArray()
    return {f: float(coefficients[i]) for i, f in enumerate(numeric)}


def level_weights(model: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, dict[str, float]]:
    """Weight of each level of each categorical feature of a fitted logistic pipeline."""
    labels = model.stages[0].labelsArray if categorical else []
    sizes = model.stages[1].categorySizes if categorical else []
    coefficients = model.stages[-1].coefficients.toArray()
    out, at = {}, len(numeric)
    for name, levels, size in zip(categorical, labels, sizes, strict=True):
        width = int(size)
        out[name] = {level: float(coefficients[at + i]) for i, level in enumerate(levels) if i < width}
        at += width
    return out


