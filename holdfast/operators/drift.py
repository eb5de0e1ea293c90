"""Drift report: one row per split pair and feature.

Numeric features are counted into buckets in one scan; exact decile edges and KS distances come from the few buckets
that hold them (:mod:`holdfast.operators.refine`). PSI over the edges is one map-side aggregate. Values are counted one
by one over all data only for features with fewer than three distinct edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.refine import Refined, quantiles, refine, rows_where
from holdfast.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, REPORT_SPLIT_ORDER, SPLIT_COLUMN, TARGET_COLUMN
from holdfast.session import materialize

EPSILON = 1e-6
MISSING = "__MISSING__"
DECILES = tuple(i / 10 for i in range(11))


@dataclass(frozen=True)
class DriftThresholds:
    """Fixed values: (moderate, high) cuts per measure."""

    psi: tuple[float, float] = (0.10, 0.25)
    secondary: tuple[float, float] = (0.10, 0.20)
    missing_delta: tuple[float, float] = (0.05, 0.15)


def split_pairs(order: Sequence[str] = REPORT_SPLIT_ORDER, reference: str = "train") -> list[tuple[str, str]]:
    """Reference pairs first, then the other combinations in order. Pairs with an absent split drop out later."""
    first = [(reference, s) for s in order if s != reference] if reference in order else []
    return first + [p for p in combinations(order, 2) if p not in set(first)]


def _psi_term(r: Column, c: Column) -> Column:
    a, b = F.greatest(r, F.lit(EPSILON)), F.greatest(c, F.lit(EPSILON))
    return (b - a) * F.ln(b / a)


def _entropy_term(p: Column, m: Column) -> Column:
    return F.when(p > 0, p * F.ln(p / m)).otherwise(F.lit(0.0))


def _share(n: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), total.cast("double")), F.lit(0.0))


def severity(psi: Column, secondary: Column, missing_delta: Column, t: DriftThresholds = DriftThresholds()) -> Column:
    """high or moderate when any measure reaches its cut, else stable."""

    def any_of(level: int) -> Column:
        return (psi >= t.psi[level]) | (secondary >= t.secondary[level]) | (missing_delta >= t.missing_delta[level])

    return F.when(any_of(1), "high").when(any_of(0), "moderate").otherwise("stable")


def severity_rank(level: Column) -> Column:
    return F.when(level == "high", 3).when(level == "moderate", 2).otherwise(1)


def ks_pvalue(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p-value: the Kolmogorov series at sqrt(round(nm/(n+m))) times the distance."""
    size = F.rint(n.cast("double") * m / (n + m))
    lam = F.sqrt(size) * distance
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # Below this the series is 1 to double precision but converges too slowly to sum.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0)))


def value_profile(refined: Refined, features: Sequence[str]) -> DataFrame:
    """(feature, value, n_0, n_1, ...): rows per split of each distinct value of some features, missing as a value of its own."""
    long = refined.values.select(refined.group, *features).unpivot([refined.group], list(features), "feature", "value")
    return long.groupBy("feature", "value").agg(*refined.counts())


def categorical_profile(df: DataFrame, features: Sequence[str], splits: Sequence[str]) -> DataFrame:
    """(feature, value, n_i, null_i): as the numeric profile, with missing as the category ``__MISSING__``."""
    long = df.select(SPLIT_COLUMN, *[F.col(c).cast("string").alias(c) for c in features]).unpivot(
        [SPLIT_COLUMN], list(features), "feature", "raw"
    )
    return long.groupBy("feature", F.coalesce("raw", F.lit(MISSING)).alias("value")).agg(
        *[rows_where(F.col(SPLIT_COLUMN) == s).alias(f"n_{i}") for i, s in enumerate(splits)],
        *[rows_where((F.col(SPLIT_COLUMN) == s) & F.col("raw").isNull()).alias(f"null_{i}") for i, s in enumerate(splits)],
    )


def with_means(totals: DataFrame, n_splits: int) -> DataFrame:
    """Totals with the mean of each split; 0 where a split has no value."""
    return totals.withColumns({f"mean_{i}": F.coalesce(F.try_divide(F.col(f"sum_{i}"), F.col(f"valid_{i}")), F.lit(0.0)) for i in range(n_splits)})


def decile_edges(refined: Refined, references: Sequence[int]) -> DataFrame:
    """(feature, ref, edges): distinct decile edges of each reference split in rising order."""
    found = quantiles(refined, DECILES, references)
    return found.groupBy("feature", "ref").agg(F.array_sort(F.collect_set("quantile")).alias("edges"))


def binned_psi(refined: Refined, totals: DataFrame, edges: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """(feature, bin_psi_r_c...): PSI over right-closed bins of the reference edges with open outer ends.

    Each value finds its bin for every reference in one pass, and the counts of those bins combine before the shuffle.
    """
    n_splits, references = len(refined.groups), sorted({r for r, _ in pairs})
    inner = F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0)))
    wide = edges.groupBy("feature").agg(*[F.max(F.when(F.col("ref") == r, inner)).alias(f"edges_{r}") for r in references])
    placed = refined.long().join(F.broadcast(wide), "feature").select("feature", refined.group, *[
        F.size(F.filter(F.coalesce(F.col(f"edges_{r}"), F.array().cast("array<double>")), lambda e: e < F.col("value"))).alias(f"bin_{r}") for r in references
    ])
    counts = placed.groupBy("feature", *[f"bin_{r}" for r in references]).agg(*refined.counts())
    by_reference = counts.select("feature", F.explode(F.array(*[
        F.struct(F.lit(r).alias("ref"), F.col(f"bin_{r}").alias("bin")) for r in references
    ])).alias("_b"), *[f"n_{i}" for i in range(n_splits)]).groupBy("feature", "_b.ref", "_b.bin").agg(*[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(n_splits)])
    with_totals = by_reference.join(F.broadcast(totals), "feature")

    def part(r: int, c: int) -> Column:
        term = _psi_term(_share(F.col(f"n_{r}"), F.col(f"valid_{r}")), _share(F.col(f"n_{c}"), F.col(f"valid_{c}")))
        return F.sum(F.when(F.col("ref") == r, term)).alias(f"bin_psi_{r}_{c}")

    return with_totals.groupBy("feature").agg(*[part(r, c) for r, c in pairs])


def value_psi(profile: DataFrame, totals: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """(feature, value_psi_r_c..., js_r_c...): PSI and Jensen-Shannon distance over single values."""
    rows = profile.join(F.broadcast(totals), "feature")
    out = []
    for r, c in pairs:
        p, q = _share(F.col(f"n_{r}"), F.col(f"rows_{r}")), _share(F.col(f"n_{c}"), F.col(f"rows_{c}"))
        m = (p + q) / F.lit(2.0)
        out.append(F.sum(_psi_term(p, q)).alias(f"value_psi_{r}_{c}"))
        out.append(F.sqrt(F.greatest(F.sum(_entropy_term(p, m) + _entropy_term(q, m)), F.lit(0.0)) / F.lit(2.0)).alias(f"js_{r}_{c}"))
    return rows.groupBy("feature").agg(*out)


def ks_distances(refined: Refined, totals: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """(feature, ks_r_c...): largest gap between the two cumulative shares, at bucket ends and at refined values."""
    rows = refined.ranked.join(F.broadcast(totals), "feature")

    def cumulative(i: int) -> Column:
        return _share(F.col(f"below_n_{i}") + F.col(f"n_{i}"), F.col(f"valid_{i}"))

    inner = rows.groupBy("feature").agg(*[F.max(F.abs(cumulative(r) - cumulative(c))).alias(f"_in_{r}_{c}") for r, c in pairs])
    return refined.edge_gaps.join(inner, "feature", "left").select(
        "feature", *[F.greatest(f"gap_{r}_{c}", f"_in_{r}_{c}").alias(f"ks_{r}_{c}") for r, c in pairs]
    )


def _report_rows(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return wide.select("feature", F.explode(F.array(*entries)).alias("_r")).select("_r.*", "feature").filter(
        (F.col("_reference_rows") > 0) & (F.col("_comparison_rows") > 0)
    ).drop("_reference_rows", "_comparison_rows")


def _missing_rate(i: int) -> Column:
    return F.lit(1.0) - _share(F.col(f"valid_{i}"), F.col(f"rows_{i}"))


def numeric_rows(
    df: DataFrame, features: Sequence[str], splits: Sequence[str], pairs: Sequence[tuple[str, str]], target: str | None
) -> DataFrame:
    """Report rows of the numeric features and the target."""
    index = {s: i for i, s in enumerate(splits)}
    numbered = [(index[r], index[c]) for r, c in pairs]
    columns = list(features) + ([target] if target else [])
    references = sorted({r for r, _ in numbered})
    refined = refine(df, SPLIT_COLUMN, splits, columns, DECILES, references, numbered)
    totals = with_means(refined.totals, len(splits))
    edges = materialize(decile_edges(refined, references), "decile_edges")
    # At most one row per feature.
    few = [r.feature for r in edges.groupBy("feature").agg(F.min(F.size("edges")).alias("k"), F.count("*").alias("n")).filter(
        (F.col("k") < 3) | (F.col("n") < len(references))
    ).collect()]
    single = value_profile(refined, sorted({*few, *([target] if target else [])})) if few or target else None
    edge_counts = edges.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.struct("ref", F.size("edges").alias("k")))).alias("_edge_counts")
    )
    wide = (
        totals.join(binned_psi(refined, totals, edges, numbered), "feature", "left")
        .join(ks_distances(refined, totals, numbered), "feature", "left")
        .join(edge_counts, "feature", "left")
    )
    if single is None:
        wide = wide.withColumns({f"value_psi_{r}_{c}": F.lit(None).cast("double") for r, c in numbered})
    else:
        wide = wide.join(value_psi(single, totals, numbered), "feature", "left")
    is_target = F.col("feature") == (target or "")
    entries = []
    for (reference, comparison), (r, c) in zip(pairs, numbered, strict=True):
        empty = (F.col(f"valid_{r}") == 0) | (F.col(f"valid_{c}") == 0)
        binned = F.coalesce(F.element_at("_edge_counts", F.lit(r)), F.lit(0)) >= 3
        psi = (
            F.when(is_target, F.col(f"value_psi_{r}_{c}")).when(empty, F.lit(0.0))
            .when(binned, F.col(f"bin_psi_{r}_{c}")).otherwise(F.col(f"value_psi_{r}_{c}"))
        )
        ks = F.when(empty, F.lit(0.0)).otherwise(F.col(f"ks_{r}_{c}"))
        p_value = F.when(empty, F.lit(1.0)).otherwise(ks_pvalue(F.col(f"ks_{r}_{c}"), F.col(f"valid_{r}"), F.col(f"valid_{c}")))
        mean_gap = F.abs(F.col(f"mean_{r}") - F.col(f"mean_{c}"))
        missing_delta = F.abs(_missing_rate(r) - _missing_rate(c))
        entries.append(F.struct(
            F.lit(reference).alias("reference_split"), F.lit(comparison).alias("comparison_split"),
            F.when(is_target, "target").otherwise("numeric").alias("feature_type"),
            psi.alias("psi"),
            F.when(is_target, "churn_rate_delta").otherwise("ks_statistic").alias("secondary_metric_name"),
            F.when(is_target, mean_gap).otherwise(ks).alias("secondary_metric"),
            F.when(~is_target, p_value).alias("secondary_pvalue"),
            _missing_rate(r).alias("reference_missing_rate"), _missing_rate(c).alias("comparison_missing_rate"),
            F.when(is_target, F.lit(0.0)).otherwise(missing_delta).alias("missing_rate_delta"),
            F.col(f"mean_{r}").alias("reference_mean"), F.col(f"mean_{c}").alias("comparison_mean"),
            F.lit("").alias("reference_top_value"), F.lit("").alias("comparison_top_value"),
            F.col(f"rows_{r}").alias("_reference_rows"), F.col(f"rows_{c}").alias("_comparison_rows"),
        ))
    return _report_rows(wide, entries)


def categorical_rows(df: DataFrame, features: Sequence[str], splits: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    index = {s: i for i, s in enumerate(splits)}
    numbered = [(index[r], index[c]) for r, c in pairs]
    profile = categorical_profile(df, features, splits)
    aggregates = []
    for i in range(len(splits)):
        aggregates += [
            F.sum(f"n_{i}").alias(f"rows_{i}"), (F.sum(f"n_{i}") - F.sum(f"null_{i}")).alias(f"valid_{i}"),
            F.min(F.when(F.col(f"n_{i}") > 0, F.struct(-F.col(f"n_{i}"), "value"))).getField("value").alias(f"top_{i}"),
        ]
    totals = profile.groupBy("feature").agg(*aggregates)
    wide = totals.join(value_psi(profile, totals, numbered), "feature")
    entries = []
    for (reference, comparison), (r, c) in zip(pairs, numbered, strict=True):
        nothing = F.lit(None).cast("double")
        entries.append(F.struct(
            F.lit(reference).alias("reference_split"), F.lit(comparison).alias("comparison_split"),
            F.lit("categorical").alias("feature_type"), F.col(f"value_psi_{r}_{c}").alias("psi"),
            F.lit("jensen_shannon_distance").alias("secondary_metric_name"), F.col(f"js_{r}_{c}").alias("secondary_metric"),
            nothing.alias("secondary_pvalue"),
            _missing_rate(r).alias("reference_missing_rate"), _missing_rate(c).alias("comparison_missing_rate"),
            F.abs(_missing_rate(r) - _missing_rate(c)).alias("missing_rate_delta"),
            nothing.alias("reference_mean"), nothing.alias("comparison_mean"),
            F.col(f"top_{r}").alias("reference_top_value"), F.col(f"top_{c}").alias("comparison_top_value"),
            F.col(f"rows_{r}").alias("_reference_rows"), F.col(f"rows_{c}").alias("_comparison_rows"),
        ))
    return _report_rows(wide, entries)


def analyze(
    df: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
    target: str | None = TARGET_COLUMN, reference: str = "train", order: Sequence[str] = REPORT_SPLIT_ORDER,
    thresholds: DriftThresholds = DriftThresholds(),
) -> DataFrame:
    """The drift report in the declared column order, reference pairs first and worst first."""
    from holdfast.schemas import DRIFT_REPORT_SCHEMA

    present = set(df.columns)
    pairs = split_pairs(order, reference)
    numeric_here = [c for c in numeric if c in present]
    categorical_here = [c for c in categorical if c in present]
    target_here = target if target in present else None
    parts = []
    if numeric_here or target_here:
        parts.append(numeric_rows(df, numeric_here, order, pairs, target_here))
    if categorical_here:
        parts.append(categorical_rows(df, categorical_here, order, pairs))
    rows = reduce(DataFrame.unionByName, parts)
    level = severity(F.col("psi"), F.col("secondary_metric"), F.col("missing_rate_delta"), thresholds)
    graded = rows.withColumn("severity", level).withColumn("severity_rank", severity_rank(F.col("severity"))).withColumn(
        "is_reference_comparison", F.col("reference_split") == reference
    )
    return graded.select(*DRIFT_REPORT_SCHEMA.fieldNames()).orderBy(
        F.desc("is_reference_comparison"), F.desc("severity_rank"), F.desc("psi"), "feature", "comparison_split", "reference_split"
    )


def reference_rows(report: DataFrame) -> DataFrame:
    """Reference comparisons, or every row when the report has none."""
    any_reference = report.agg(F.coalesce(F.bool_or("is_reference_comparison"), F.lit(False)).alias("x")).scalar()
    return report.filter(F.col("is_reference_comparison") | ~any_reference)


def summary_counts(report: DataFrame) -> DataFrame:
    """One row: compared pairs, features, and features by their worst severity."""
    worst = reference_rows(report).groupBy("feature").agg(F.max("severity_rank").alias("rank"))
    pairs = report.agg(F.count_distinct("reference_split", "comparison_split").alias("n")).scalar()
    return worst.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if(F.col("rank") == 3).alias("high_drift_features"),
        F.count_if(F.col("rank") == 2).alias("moderate_drift_features"),
        F.count_if(F.col("rank") == 1).alias("stable_features"),
    ).select(pairs.alias("total_comparisons"), "*")


def top_drift(report: DataFrame, n: int) -> DataFrame:
    return reference_rows(report).select(
        "reference_split", "comparison_split", "feature", "feature_type", "psi", "secondary_metric",
        "missing_rate_delta", "severity", "severity_rank",
    ).orderBy(F.desc("severity_rank"), F.desc("psi"), "feature", "comparison_split").limit(n).drop("severity_rank")


def dashboard_rows(report: DataFrame, level: str, n: int | None = None) -> DataFrame:
    """All reference rows of one severity, in report order; only the first ``n`` if given."""
    rows = reference_rows(report).filter(F.col("severity") == level).orderBy(
        F.desc("severity_rank"), F.desc("psi"), "feature", "comparison_split"
    )
    return rows if n is None else rows.limit(n)
