"""Classifier metrics grouped by split. Input rows: (split_name, label 0/1, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import even_round
from holdfast.operators.prefix import exact_quantiles, prefix_sums
from holdfast.schemas import SPLIT_COLUMN

# The default decision cuts.
DEFAULT_CUTS = tuple(round(0.02 + 0.04 * i, 3) for i in range(10))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f_score(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    b2 = beta * beta
    return F.coalesce(F.try_divide(F.lit(1 + b2) * precision * recall, F.lit(b2) * precision + recall), F.lit(0.0))


def cell_counts(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """(split_name, tn, fp, fn, tp) in one aggregate."""
    positive, flagged = F.col(label) == 1, F.col(score) >= threshold
    return scores.groupBy(SPLIT_COLUMN).agg(
        F.count_if(~positive & ~flagged).alias("tn"), F.count_if(~positive & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"), F.count_if(positive & flagged).alias("tp"),
    )


def threshold_metrics(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    c = cell_counts(scores, threshold, label, score)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return c.select(
        SPLIT_COLUMN, _ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), _f_score(precision, recall).alias("f1"),
    )


def score_profile(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(split_name, score, pos, neg, below_pos, below_neg): grouped scores with the classes below each."""
    grouped = scores.groupBy(SPLIT_COLUMN, F.col(score).cast("double").alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg")
    )
    return prefix_sums(grouped, "score", ["pos", "neg"], [SPLIT_COLUMN])


def ranking_metrics(scores: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Average precision (step sum over distinct scores) and ROC AUC (tie-aware rank sum; 0 with one class)."""
    profile = score_profile(scores, label, score)
    totals = profile.groupBy(SPLIT_COLUMN).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    rows = profile.join(F.broadcast(totals), SPLIT_COLUMN)
    tp, fp = F.col("_p") - F.col("below_pos"), F.col("_n") - F.col("below_neg")
    step = _ratio(F.col("pos"), F.col("_p")) * _ratio(tp, tp + fp)
    below = F.col("pos") * (F.col("below_neg") + F.col("neg") / F.lit(2.0))
    return rows.groupBy(SPLIT_COLUMN).agg(
        F.sum(step).alias("average_precision"),
        F.coalesce(F.try_divide(F.sum(below), F.max("_p").cast("double") * F.max("_n")), F.lit(0.0)).alias("auc"),
    )


def evaluate(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """All metrics, one row per split."""
    return threshold_metrics(scores, threshold, label, score).join(ranking_metrics(scores, label, score), SPLIT_COLUMN).select(
        SPLIT_COLUMN, "accuracy", "f1", "precision", "recall", "average_precision", "auc"
    )


def confusion_cells(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Long confusion matrix: all four cells of every split, zeros included."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual_label"), F.lit(p).alias("predicted_label"), F.col(c).alias("rows"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    return cell_counts(scores, threshold, label, score).select(SPLIT_COLUMN, F.explode(cells).alias("_c")).select(SPLIT_COLUMN, "_c.*")


def confusion_shares(cells: DataFrame) -> DataFrame:
    """Cells with their share of the actual class and of the split, and the split's precision and recall."""
    def cell(a: int, p: int) -> Column:
        hit = (F.col("actual_label") == a) & (F.col("predicted_label") == p)
        return F.sum(F.when(hit, F.col("rows")).otherwise(0)).over(by_split)

    by_split = Window.partitionBy(SPLIT_COLUMN)
    row_total = F.sum("rows").over(Window.partitionBy(SPLIT_COLUMN, "actual_label"))

    def floor_one(c: Column) -> Column:
        return F.greatest(c, F.lit(1))

    return cells.select(
        "*",
        (F.col("rows") / floor_one(row_total)).alias("row_share"),
        (F.col("rows") / floor_one(F.sum("rows").over(by_split))).alias("total_share"),
        (cell(1, 1) / floor_one(cell(1, 1) + cell(0, 1))).alias("precision"),
        (cell(1, 1) / floor_one(cell(1, 1) + cell(1, 0))).alias("recall"),
    )


def threshold_grid(
    scores: DataFrame, cuts: Sequence[float] = DEFAULT_CUTS, beta: float = 2.0, label: str = "label", score: str = "score",
    keys: Sequence[str] = (), positive_label: str = "churn",
) -> DataFrame:
    """One row per cut (and key): cells, rates and F scores at three digits. One pass with two counters per cut."""
    positive = F.col(label) == 1
    counters = []
    for i, cut in enumerate(cuts):
        flagged = F.col(score) >= F.lit(float(cut))
        counters += [F.count_if(flagged).alias(f"_a{i}"), F.count_if(flagged & positive).alias(f"_t{i}")]
    totals = scores.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(positive).alias("_pos"), *counters)
    entries = F.array(*[
        F.struct(F.lit(float(cut)).alias("threshold"), F.col(f"_a{i}").alias("flagged"), F.col(f"_t{i}").alias("tp"))
        for i, cut in enumerate(cuts)
    ])
    rows = totals.select(*keys, "_rows", "_pos", F.explode(entries).alias("_e")).select(*keys, "_rows", "_pos", "_e.*")
    tp, fp, fn = F.col("tp"), F.col("flagged") - F.col("tp"), F.col("_pos") - F.col("tp")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return rows.select(
        *keys, "threshold",
        (F.col("_rows") - F.col("flagged") - fn).alias("true_non_churn"), fp.alias("false_alarms"),
        fn.alias(f"{positive_label}_missed"), tp.alias(f"{positive_label}_detected"),
        even_round(precision, 3).alias("precision"), even_round(recall, 3).alias("recall"),
        even_round(_f_score(precision, recall), 3).alias("f1"),
        even_round(_f_score(precision, recall, beta), 3).alias(f"f{beta:g}"),
        even_round(_ratio(F.col("flagged"), F.col("_rows")), 3).alias("alert_rate"),
        even_round(_ratio(F.col("_pos"), F.col("_rows")), 3).alias("true_positive_rate"),
    )


def best_threshold(grid: DataFrame, beta: float = 2.0, keys: Sequence[str] = ()) -> DataFrame:
    """The cut with the best F-beta, then recall, then precision, then the lowest cut."""
    name = f"f{beta:g}"
    best = F.max(F.struct(name, "recall", "precision", (-F.col("threshold")).alias("_low"))).alias("_b")
    return grid.groupBy(*keys).agg(best).select(
        *keys, (-F.col("_b._low")).alias("threshold"), F.col(f"_b.{name}").alias(name),
        F.col("_b.recall").alias("recall"), F.col("_b.precision").alias("precision"),
    )


def score_distribution(scores: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Per split: min, p50, p90, p95, p99 and max score (exact, interpolated) and predicted positives."""
    grouped = scores.groupBy(SPLIT_COLUMN, F.col(score).cast("double").alias("score")).agg(F.count(F.lit(1)).alias("rows"))
    ranked = prefix_sums(grouped, "score", ["rows"], [SPLIT_COLUMN])
    probabilities = (0.5, 0.9, 0.95, 0.99)
    quantiles = exact_quantiles(ranked, "score", "rows", probabilities, [SPLIT_COLUMN])
    names = [f"p{round(p * 100)}" for p in probabilities]
    wide = quantiles.groupBy(SPLIT_COLUMN).agg(*[
        F.max(F.when(F.col("quantile_index") == i, F.col("quantile"))).alias(n) for i, n in enumerate(names)
    ])
    ends = scores.groupBy(SPLIT_COLUMN).agg(
        F.count(F.lit(1)).alias("rows"), F.min(score).alias("min"), F.max(score).alias("max"),
        F.count_if(F.col(score) >= threshold).alias("predicted_positives"),
    )
    return ends.join(wide, SPLIT_COLUMN).select(SPLIT_COLUMN, "rows", "min", *names, "max", "predicted_positives")


def split_summary(df: DataFrame, target: str = "churn_label", time: str = "observation_date") -> DataFrame:
    return df.groupBy(SPLIT_COLUMN).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(target).alias("churn_rate"), F.min(time).alias("min_time"), F.max(time).alias("max_time")
    )


def top_k_metrics(
    scores: DataFrame, ks: Sequence[int], ids: Sequence[str], label: str = "label", score: str = "score"
) -> DataFrame:
    """Precision, recall, gain and lift among the K best scores per split (a measure the reference only plans).

    Equal scores are ordered by ``ids``. Only the largest K rows of a split leave a task, so a constant score is no
    hot key.
    """
    rows = scores.select(SPLIT_COLUMN, *ids, F.col(label).alias("_y"), F.col(score).cast("double").alias("_score"))
    rows = rows.filter(F.col(SPLIT_COLUMN).isNotNull() & F.col("_score").isNotNull())
    positive = F.col("_y") == 1
    order = Window.partitionBy(SPLIT_COLUMN).orderBy(F.desc("_score"), *ids)
    best = rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= max(ks))
    found = best.groupBy(SPLIT_COLUMN).agg(*[F.count_if(positive & (F.col("_place") <= k)).alias(f"_h{i}") for i, k in enumerate(ks)])
    totals = rows.groupBy(SPLIT_COLUMN).agg(F.count(F.lit(1)).alias("_rows"), F.count_if(positive).alias("_pos"))
    hits = totals.join(found, SPLIT_COLUMN)
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_h{i}").alias("hits")) for i, k in enumerate(ks)])
    rows = hits.select(SPLIT_COLUMN, "_rows", "_pos", F.explode(entries).alias("_e")).select(SPLIT_COLUMN, "_rows", "_pos", "_e.*")
    precision = _ratio(F.col("hits"), F.least(F.col("k"), F.col("_rows")))
    return rows.select(
        SPLIT_COLUMN, "k", "hits", precision.alias("precision_at_k"), _ratio(F.col("hits"), F.col("_pos")).alias("recall_at_k"),
        _ratio(precision, _ratio(F.col("_pos"), F.col("_rows"))).alias("lift_at_k"),
    )


