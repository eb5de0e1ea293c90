"""Exact order statistics of many features by counting into buckets and refining only the buckets that matter.

All features are counted in one scan into equal-width buckets between their smallest and largest value: at most
``BUCKETS`` + 2 rows a feature, whatever the size of the data. From those counts follows which buckets hold the asked
quantiles, and which ones could hold the largest gap between two cumulative distributions: within a bucket the gap moves
by no more than the bucket's own shares. Single values are then counted in those buckets alone. Buckets steer the work,
never the result; where one bucket holds most values, the refined table is as long as a table of all values would be.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import number
from holdfast.operators.prefix import prefix_sums
from holdfast.session import materialize

BUCKETS = 2048


def rows_where(condition: Column) -> Column:
    """Counts as ``count(when)``: unlike ``count_if`` it plans the same in every branch, so shuffles are reused."""
    return F.count(F.when(condition, 1))


@dataclass(frozen=True)
class Refined:
    """What the counts of groups (splits) gave. i numbers the groups.

    ``values`` is the stored (group, feature...) table, ``totals`` (feature, rows_i, valid_i, sum_i, low, high), ``ranked``
    (feature, value, n_i, below_n_i) for the values of refined buckets, ``edge_gaps`` (feature, gap_r_c...).
    """

    values: DataFrame
    totals: DataFrame
    ranked: DataFrame
    edge_gaps: DataFrame
    group: str
    groups: tuple[str, ...]
    features: tuple[str, ...]

    def long(self) -> DataFrame:
        """(group, feature, value) without missing values."""
        return self.values.unpivot([self.group], list(self.features), "feature", "value").filter(F.col("value").isNotNull())

    def counts(self) -> list[Column]:
        return [rows_where(F.col(self.group) == g).alias(f"n_{i}") for i, g in enumerate(self.groups)]


def _bucket(buckets: int) -> Column:
    """The bucket of ``value`` between ``low`` and ``high``; infinite values lie outside. It never falls as the value rises."""
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    place = F.floor(F.try_divide(value - low, high - low) * buckets)
    return (
        F.when(value == float("-inf"), -1).when(value == float("inf"), buckets)
        .otherwise(F.least(F.coalesce(place, F.lit(0)), F.lit(buckets - 1))).cast("int")
    )


def _totals(values: DataFrame, group: str, groups: Sequence[str], features: Sequence[str]) -> DataFrame:
    long = values.unpivot([group], list(features), "feature", "value")
    valid, finite = F.col("value").isNotNull(), F.abs("value") < float("inf")
    measures = []
    for i, g in enumerate(groups):
        own = F.col(group) == g
        measures += [
            rows_where(own).alias(f"rows_{i}"), rows_where(own & valid).alias(f"valid_{i}"), F.sum(F.when(own, F.col("value"))).alias(f"sum_{i}"),
        ]
    bounds = [F.min(F.when(finite, F.col("value"))).alias("low"), F.max(F.when(finite, F.col("value"))).alias("high")]
    return long.groupBy("feature").agg(*measures, *bounds)


def refine(
    df: DataFrame, group: str, groups: Sequence[str], features: Sequence[str], probabilities: Sequence[float], references: Sequence[int],
    pairs: Sequence[tuple[int, int]] = (), buckets: int = BUCKETS,
) -> Refined:
    """Count ``features`` of ``df`` by ``group`` and refine what the quantiles of the reference groups, and the largest
    gaps of the pairs, need. A feature that is missing throughout has totals only."""
    numbers = range(len(groups))
    values = materialize(df.select(group, *[number(f"`{c}`").alias(c) for c in features]), "numeric_values")
    totals = materialize(_totals(values, group, groups, features), "numeric_totals")
    refined = Refined(values, totals, totals, totals, group, tuple(groups), tuple(features))
    # One row per feature.
    placed = refined.long().join(F.broadcast(totals.select("feature", "low", "high")), "feature").withColumn("bucket", _bucket(buckets))
    histogram = materialize(placed.groupBy("feature", "bucket").agg(*refined.counts()), "histogram")

    before = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    valid = totals.select("feature", *[f"valid_{i}" for i in numbers])
    below = histogram.join(F.broadcast(valid), "feature").select(
        "*", *[F.coalesce(F.sum(f"n_{i}").over(before), F.lit(0)).alias(f"low_{i}") for i in numbers]
    )

    def share(i: int, inside: bool) -> Column:
        n = F.col(f"low_{i}") + F.col(f"n_{i}") if inside else F.col(f"low_{i}")
        return F.coalesce(F.try_divide(n.cast("double"), F.col(f"valid_{i}")), F.lit(0.0))

    gaps = below.groupBy("feature").agg(F.lit(0).alias("_"), *[
        F.max(F.abs(share(r, True) - share(c, True))).alias(f"gap_{r}_{c}") for r, c in pairs
    ]).drop("_")

    def holds_rank(i: int) -> Column:
        low, high = F.col(f"low_{i}"), F.col(f"low_{i}") + F.col(f"n_{i}")
        ranks = [round_((F.col(f"valid_{i}") - 1) * F.lit(float(p))) for p in probabilities for round_ in (F.floor, F.ceil)]
        return F.exists(F.array(*ranks), lambda h: (h >= low) & (h < high))

    def may_gap(r: int, c: int) -> Column:
        start, end = share(r, False) - share(c, False), share(r, True) - share(c, True)
        highest = F.greatest(F.abs(share(r, True) - share(c, False)), F.abs(share(r, False) - share(c, True)), F.abs(start), F.abs(end))
        return highest > F.col(f"gap_{r}_{c}")

    needed = F.lit(False)
    for i in references:
        needed = needed | holds_rank(i)
    for r, c in pairs:
        needed = needed | may_gap(r, c)
    # At most BUCKETS + 2 rows per feature, so the broadcasts below are bounded.
    chosen = below.join(F.broadcast(gaps), "feature").filter(needed)
    earlier = [F.coalesce(F.sum(f"n_{i}").over(before), F.lit(0)) for i in numbers]
    chosen = materialize(chosen.select("feature", "bucket", *[(F.col(f"low_{i}") - earlier[i]).alias(f"skipped_{i}") for i in numbers]), "chosen_buckets")
    # Stored, since the prefix sums read it for their edges and again for their sums: else all values are scanned each time.
    profile = materialize(
        placed.join(F.broadcast(chosen.select("feature", "bucket")), ["feature", "bucket"]).groupBy("feature", "bucket", "value").agg(*refined.counts()), "bucket_values"
    )
    ranked = prefix_sums(profile, "value", [f"n_{i}" for i in numbers], ["feature"]).join(F.broadcast(chosen), ["feature", "bucket"])
    ranked = ranked.select("feature", "value", *[f"n_{i}" for i in numbers], *[
        (F.col(f"below_n_{i}") + F.col(f"skipped_{i}")).alias(f"below_n_{i}") for i in numbers
    ])
    return Refined(values, totals, materialize(ranked, "refined_profile"), gaps, group, tuple(groups), tuple(features))


def quantiles(refined: Refined, probabilities: Sequence[float], references: Sequence[int]) -> DataFrame:
    """(feature, ref, quantile_index, quantile), linearly interpolated, for the probabilities that were refined."""
    stacked = refined.ranked.join(F.broadcast(refined.totals), "feature").select("feature", "value", F.explode(F.array(*[
        F.struct(F.lit(i).alias("ref"), F.col(f"n_{i}").alias("n"), F.col(f"below_n_{i}").alias("first"), F.col(f"valid_{i}").alias("size"))
        for i in references
    ])).alias("_s")).select("feature", "value", "_s.*").filter("n > 0")
    last = F.col("first") + F.col("n") - 1
    positions = F.array(*[
        F.struct(F.lit(i).alias("i"), ((F.col("size") - 1) * F.lit(float(p))).alias("h")) for i, p in enumerate(probabilities)
    ])
    hits = stacked.select("feature", "ref", "value", "first", last.alias("last"), F.explode(F.filter(
        positions, lambda q: F.floor(q["h"]).between(F.col("first"), last) | F.ceil(q["h"]).between(F.col("first"), last)
    )).alias("_hit"))
    h = F.col("_hit.h")
    picked = hits.groupBy("feature", "ref", F.col("_hit.i").alias("quantile_index")).agg(
        F.max(h).alias("_h"),
        F.max(F.when(F.floor(h).between(F.col("first"), F.col("last")), F.col("value"))).alias("_low"),
        F.max(F.when(F.ceil(h).between(F.col("first"), F.col("last")), F.col("value"))).alias("_high"),
    )
    part = F.col("_h") - F.floor("_h")
    return picked.select("feature", "ref", "quantile_index", (F.col("_low") + (F.col("_high") - F.col("_low")) * part).alias("quantile"))
