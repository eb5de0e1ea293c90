"""Fill values fitted on the training split, temporal splits and class distributions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import number
from holdfast.operators.refine import quantiles, refine
from holdfast.schemas import (
    CATEGORICAL_FEATURES, FEATURE_COLUMNS, ID_COLUMNS, NUMERIC_FEATURES, SPLIT_COLUMN, SPLIT_ORDER, TARGET_COLUMN,
)


def _require(df: DataFrame, columns: Sequence[str], kind: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing {kind} feature for preprocessing: {missing[0]}")


def numeric_medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(feature, fill_value) per numeric column.

    The exact median counts into buckets and refines the one that holds it, because the built-in exact
    aggregate holds all distinct values of a column in one buffer. ``exact=False`` uses a sketch.
    """
    if exact:
        refined = refine(df.withColumn("_all", F.lit("all")), "_all", ["all"], columns, [0.5], [0])
        found = quantiles(refined, [0.5], [0]).select("feature", F.col("quantile").alias("_median"))
    else:
        values = df.select(*[number(c).alias(c) for c in columns])
        wide = values.agg(*[F.percentile_approx(c, 0.5, 10000).alias(c) for c in columns])
        found = wide.unpivot([], list(columns), "feature", "_median")
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(found, "feature", "left").select("feature", F.coalesce("_median", F.lit(0.0)).alias("fill_value"))


def categorical_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill_value) per categorical column; ties go to the smallest text."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))
    found = counts.groupBy("feature").agg(F.min(F.struct(-F.col("rows"), "value")).getField("value").alias("_mode"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(found, "feature", "left").select("feature", F.coalesce("_mode", F.lit("UNKNOWN")).alias("fill_value"))


@dataclass
class FillValues:
    """Fitted fill values, one literal per feature; :meth:`fit` runs two small actions (one row per feature)."""

    numeric_features: Sequence[str] = NUMERIC_FEATURES
    categorical_features: Sequence[str] = CATEGORICAL_FEATURES
    target: str = TARGET_COLUMN
    exact: bool = True
    numeric: dict[str, float] | None = None
    categorical: dict[str, str] | None = None

    def fit(self, train: DataFrame) -> FillValues:
        _require(train, self.numeric_features, "numeric")
        _require(train, self.categorical_features, "categorical")
        medians = numeric_medians(train, self.numeric_features, self.exact) if self.numeric_features else None
        modes = categorical_modes(train, self.categorical_features) if self.categorical_features else None
        self.numeric = {r.feature: r.fill_value for r in medians.collect()} if medians is not None else {}
        self.categorical = {r.feature: r.fill_value for r in modes.collect()} if modes is not None else {}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.numeric is None or self.categorical is None:
            raise RuntimeError("Fill values must be fitted on the train split before transform.")
        filled: dict[str, Column] = {c: F.coalesce(number(c), F.lit(self.numeric[c])) for c in self.numeric_features}
        filled |= {c: F.coalesce(F.col(c).cast("string"), F.lit(self.categorical[c])) for c in self.categorical_features}
        filled[self.target] = F.col(self.target).cast("int")
        return df.withColumns(filled)


@dataclass(frozen=True)
class Split:
    data: DataFrame
    features: DataFrame
    target: DataFrame
    time: DataFrame


def split_bounds(df: DataFrame, order: Sequence[str] = SPLIT_ORDER, time: str = "observation_date") -> DataFrame:
    """(position, split_name, first_time, last_time, previous_last_time, ordered) over the declared order."""
    declared = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(s) for s in order])).alias("position", SPLIT_COLUMN))
    bounds = df.groupBy(SPLIT_COLUMN).agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"))
    joined = declared.join(bounds, SPLIT_COLUMN, "left").withColumn("_group", F.lit(0))
    before = F.lag("last_time").over(Window.partitionBy("_group").orderBy("position"))
    return joined.withColumn("previous_last_time", before).select(
        "position", SPLIT_COLUMN, "first_time", "last_time", "previous_last_time",
        F.coalesce(
            F.col("first_time").isNotNull() & (F.col("previous_last_time").isNull() | (F.col("first_time") > F.col("previous_last_time"))),
            F.lit(False),
        ).alias("ordered"),
    )


def validate_split_order(df: DataFrame, order: Sequence[str] = SPLIT_ORDER, time: str = "observation_date") -> None:
    """Raise when a declared split is missing or starts before the one before it ends (an action on a few rows)."""
    bounds = split_bounds(df, order, time).orderBy("position").collect()
    missing = [r[SPLIT_COLUMN] for r in bounds if r.first_time is None]
    if missing:
        raise ValueError(f"Missing expected temporal splits: {missing}")
    for r in bounds:
        if not r.ordered:
            raise ValueError(
                f"Temporal leakage risk: split {r[SPLIT_COLUMN]} starts at {r.first_time}, "
                f"before or at previous max {r.previous_last_time}."
            )


def temporal_split(
    df: DataFrame, order: Sequence[str] = SPLIT_ORDER, features: Sequence[str] = FEATURE_COLUMNS,
    target: str = TARGET_COLUMN, time: str = "observation_date", validate: bool = True,
) -> dict[str, Split]:
    """Lazy filters over one frame; on storage partitioned by split each one prunes to its own files."""
    if validate:
        validate_split_order(df, order, time)
    out = {}
    for name in order:
        rows = df.filter(F.col(SPLIT_COLUMN) == name)
        out[name] = Split(
            rows.select(*ID_COLUMNS, SPLIT_COLUMN, *features, target), rows.select(*features), rows.select(target), rows.select(time)
        )
    return out


def concat_splits(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def class_distribution(df: DataFrame, target: str = TARGET_COLUMN, order: Sequence[str] = ()) -> DataFrame:
    """Rows per (split, label) with the split's total and share; a null label is its own class."""
    counts = df.groupBy(SPLIT_COLUMN, target).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(SPLIT_COLUMN))
    out = counts.withColumn("total_rows", total).withColumn("share", F.col("rows") / F.col("total_rows"))
    return out.orderBy(*([split_rank(order)] if order else [SPLIT_COLUMN]), target)


def split_rank(order: Sequence[str], column: str = SPLIT_COLUMN) -> Column:
    """Position in the given order; unknown names come last."""
    chain = F.when(F.lit(False), 0)
    for i, name in enumerate(order, start=1):
        chain = chain.when(F.col(column) == name, i)
    return chain.otherwise(len(order) + 1)
