"""Distributed prefix sums, ranks and exact quantiles over a global order.

A window without partition keys moves every row to one task. Here the ordered values are first grouped
(equal values become one row), cut into buckets at approximate quantiles, summed inside each bucket by
a window, and shifted by the total of the buckets before. Bucket edges and bucket totals have a fixed
number of rows per key, so they are the only broadcast data. Edges steer balance, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import materialize

DEFAULT_BUCKETS = 128
_STEP = 16


def _bucket(value: Column, edges: Column) -> Column:
    """Number of edges not above the value: a coarse pass over every 16th edge, then 15 fine ones."""
    coarse = F.size(F.filter(edges["coarse"], lambda e: e <= value))
    fine = F.slice(edges["every"], coarse * _STEP + 1, F.lit(_STEP - 1))
    return coarse * _STEP + F.size(F.filter(fine, lambda e: e <= value))


def prefix_sums(
    grouped: DataFrame, value: str, measures: Sequence[str], keys: Sequence[str] = (), ties: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Add ``below_<measure>``: the sum of the measure over rows ordered strictly before, per key.

    ``grouped`` holds one row per (keys, value, ties); ``value`` is numeric and not null, measures are
    not negative. ``keys`` name a small fixed domain (splits, features), so edges and offsets have at most
    ``buckets`` entries per key: they are broadcast, or a scalar subquery when there is no key.
    """
    by = list(keys)
    if buckets is None:  # as many tasks as the session shuffles to, in whole steps
        partitions = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(DEFAULT_BUCKETS, -(-partitions // _STEP) * _STEP)
    # The joins below imply these filters; stating them first keeps every branch's shuffle identical, so it is reused.
    grouped = grouped.filter(" AND ".join(f"{c} IS NOT NULL" for c in (*by, value)))
    number = F.col(value).cast("double")
    listed = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    # The filter is always true; it keeps the measures in this branch so that all branches read one shuffle.
    balanced = grouped.filter(" AND ".join(f"{m} >= 0" for m in measures))
    sketch = balanced.groupBy(*by).agg(
        F.expr(f"percentile_approx(CAST({value} AS DOUBLE), array({listed}), {20 * buckets}) AS every")
    )
    every_16th = F.expr(f"transform(sequence({_STEP}, {buckets - 1}, {_STEP}), i -> element_at(every, i))")
    edges = sketch.select(*by, F.struct("every", every_16th.alias("coarse")).alias("_edges"))
    if by:
        with_edges = grouped.join(F.broadcast(edges), by)
    else:
        with_edges = grouped.withColumn("_edges", edges.scalar())
    placed = with_edges.withColumn("_bucket", _bucket(number, F.col("_edges"))).drop("_edges")
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket", *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures]
    )
    inside = (
        Window.partitionBy(*by, "_bucket").orderBy(value, *ties).rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.join(F.broadcast(offsets), [*by, "_bucket"]).select(
        *grouped.columns,
        *[
            (F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"_o_{m}")).alias(f"below_{m}")
            for m in measures
        ],
    )


def exact_quantiles(
    profile: DataFrame, value: str, count: str, probabilities: Sequence[float], keys: Sequence[str]
) -> DataFrame:
    """Linearly interpolated quantiles per key from a prefix-summed profile, as (keys, quantile_index, quantile).

    ``profile`` has ``value``, ``count`` and ``below_<count>`` (from :func:`prefix_sums`). Each profile row
    emits only the quantile positions that fall on it, so nothing is collected per key.
    """
    totals = profile.groupBy(*keys).agg(F.sum(count).alias("_n"))
    rows = profile.filter(F.col(count) > 0).join(F.broadcast(totals), list(keys))
    first, last = F.col(f"below_{count}"), F.col(f"below_{count}") + F.col(count) - 1
    positions = F.array(*[
        F.struct(F.lit(i).alias("i"), ((F.col("_n") - 1) * F.lit(float(p))).alias("h")) for i, p in enumerate(probabilities)
    ])
    hits = rows.withColumn("_hit", F.explode(F.filter(
        positions,
        lambda q: (F.floor(q["h"]).between(first, last)) | (F.ceil(q["h"]).between(first, last)),
    )))
    h = F.col("_hit.h")
    picked = hits.groupBy(*keys, F.col("_hit.i").alias("quantile_index")).agg(
        F.max(h).alias("_h"),
        F.max(F.when(F.floor(h).between(first, last), F.col(value).cast("double"))).alias("_low"),
        F.max(F.when(F.ceil(h).between(first, last), F.col(value).cast("double"))).alias("_high"),
    )
    part = F.col("_h") - F.floor("_h")
    return picked.select(*keys, "quantile_index", (F.col("_low") + (F.col("_high") - F.col("_low")) * part).alias("quantile"))


def spread_lookup(
    rows: DataFrame, table: DataFrame, key: str, weight: str, values: Sequence[str], spread_on: Sequence[str],
    hot_share: int = 1000,
) -> DataFrame:
    """Left-join ``rows`` to ``table`` (one row per key, ``weight`` = how many rows carry the key) without skew.

    Keys that hold more than one in ``hot_share`` of all rows are at most ``hot_share`` many, so they are
    broadcast. Their rows get a spread-out join key for the shuffled join that serves all others.
    """
    slim = table.select(key, weight, *values)
    total = slim.agg(F.sum(weight).alias("_total")).scalar()
    hot = slim.filter(F.col(weight) * hot_share > total).select(
        F.col(key).alias("_hot_key"), *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_salt", F.when(F.col("_hot_key").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*spread_on), F.lit(4096)).cast("int"))
    )
    cold = slim.withColumn("_salt", F.lit(0)).select(
        F.col(key).alias("_cold_key"), F.col("_salt").alias("_cold_salt"), *[F.col(v).alias(f"_cold_{v}") for v in values]
    )
    joined = marked.join(cold, (F.col(key) == F.col("_cold_key")) & (F.col("_salt") == F.col("_cold_salt")), "left")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(F.col(f"_hot_{v}"), F.col(f"_cold_{v}")).alias(v) for v in values],
    )


def average_percent_rank(rows: DataFrame, value: str, alias: str, spread_on: Sequence[str]) -> DataFrame:
    """Average rank over the row count, the percentile rank of pandas. ``value`` must not be null.

    The ranks of the distinct values are written to the checkpoint folder (one job), because the lookup reads
    them twice and should not rank twice.
    """
    counts = rows.groupBy(value).agg(F.count(F.lit(1)).alias("_cnt"))
    total = counts.agg(F.sum("_cnt").alias("_n")).scalar()
    share = (F.col("below__cnt") + (F.col("_cnt") + 1) / F.lit(2.0)) / total
    ranked = materialize(prefix_sums(counts, value, ["_cnt"]).select(value, "_cnt", share.alias(alias)), "ranks")
    return spread_lookup(rows, ranked, value, "_cnt", [alias], spread_on)
