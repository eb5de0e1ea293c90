"""Integrity validators. Each returns (table_name, rule, column_name, violations, total)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.schemas import TABLE_RULES, TableRules


def row_checks(df: DataFrame, table: str, rules: TableRules) -> DataFrame:
    """NOT NULL, domain, range and cross-column rules of one table: a single scan and one aggregate."""
    checks: list[tuple[str, str, Column]] = []
    for c in df.columns:
        if c not in rules.nullable:
            checks.append(("not_null", c, F.col(c).isNull()))
    for c, values in rules.domains.items():
        if c in df.columns:
            checks.append(("domain", c, ~F.col(c).isin(*values)))
    for name, expression in rules.checks.items():
        checks.append(("check", name, ~F.expr(f"({expression})")))
    return count_violations(df, table, checks)


def count_violations(df: DataFrame, table: str, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One row per check; a null condition passes, as in SQL."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(checks)]
    )
    report = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.col(f"v{i}").alias("violations"))
        for i, (rule, column, _) in enumerate(checks)
    ])
    return totals.select(F.lit(table).alias("table_name"), "total", F.explode(report).alias("_r")).select(
        "table_name", "_r.rule", "_r.column_name", "_r.violations", "total"
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return count_violations(df, table, [("not_null", c, F.col(c).isNull()) for c in columns])


def in_domain(df: DataFrame, table: str, domains: Mapping[str, Sequence]) -> DataFrame:
    return count_violations(df, table, [("domain", c, ~F.col(c).isin(*v)) for c, v in domains.items()])


def in_range(df: DataFrame, table: str, bounds: Mapping[str, tuple]) -> DataFrame:
    return count_violations(df, table, [("range", c, ~F.col(c).between(*b)) for c, b in bounds.items()])


def holds(df: DataFrame, table: str, name: str, condition: Column) -> DataFrame:
    return count_violations(df, table, [("check", name, ~condition)])


def unique_key(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key. Counts are combined before the shuffle, so a hot key is one row per task."""
    return df.groupBy(*key).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"), F.coalesce(F.sum("count"), F.lit(0)).alias("total")
    ).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column_name"),
        "violations", "total",
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The offending keys with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def foreign_key(fact: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key is missing from the parent. The fact shrinks to distinct keys before the anti join."""
    keys = fact.groupBy(F.col(column).alias("_fk")).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(parent_column).alias("_fk")).distinct().withColumn("_hit", F.lit(1))
    return keys.join(known, "_fk", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_fk").isNotNull() & F.col("_hit").isNull(), F.col("_rows"))), F.lit(0)).alias("violations"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
    ).select(
        F.lit(table).alias("table_name"), F.lit("foreign_key").alias("rule"), F.lit(column).alias("column_name"),
        "violations", "total",
    )


def orphans(fact: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The missing parent keys with the number of fact rows that carry them."""
    keys = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def integrity_report(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules] = TABLE_RULES) -> DataFrame:
    """Every declared rule of every given table that can be checked with the tables at hand."""
    parts: list[DataFrame] = []
    for name, df in tables.items():
        spec = rules.get(name)
        if spec is None:
            continue
        parts.append(row_checks(df, name, spec))
        for key in ((spec.primary_key,) if spec.primary_key else ()) + spec.unique:
            if set(key) <= set(df.columns):
                parts.append(unique_key(df, name, key))
        for column, parent, parent_column in spec.foreign_keys:
            if column in df.columns and parent in tables:
                parts.append(foreign_key(df, name, column, tables[parent], parent_column))
    return reduce(DataFrame.unionByName, parts)


def backfill_labels(labels: DataFrame) -> DataFrame:
    """Fill a missing churn date of positives with the horizon end and a missing status from the label."""
    ready = ensure_columns(labels, {"churn_date": "date", "customer_lifecycle_status": "string"})
    positive = F.col("churn_label") == 1
    end = F.date_add("observation_date", F.col("prediction_horizon_days"))
    return ready.withColumns({
        "churn_date": F.coalesce("churn_date", F.when(positive, end)),
        "customer_lifecycle_status": F.coalesce(
            "customer_lifecycle_status", F.when(positive, "CHURNED_WITHIN_HORIZON").otherwise("ACTIVE_OBSERVED")
        ),
    })


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the missing columns as typed nulls."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def with_defaults(df: DataFrame, constants: Mapping[str, object] | None = None, stamps: Sequence[str] = ()) -> DataFrame:
    """Column defaults: constants where null or absent, the current time for the stamp columns."""
    out: dict[str, Column] = {}
    for c, v in (constants or {}).items():
        out[c] = F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
    for c in stamps:
        out[c] = F.coalesce(F.col(c), F.current_timestamp()) if c in df.columns else F.current_timestamp()
    return df.withColumns(out) if out else df


def table_volumes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, ordered by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def file_volumes(spark, paths: Mapping[str, str]) -> DataFrame:
    """Row count per report path, ``missing`` where nothing is there."""
    from holdfast.sources.tables import path_exists

    rows = []
    for name, path in paths.items():
        if path_exists(spark, path):
            counted = spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).cast("string").alias("rows"))
        else:
            counted = spark.range(1).select(F.lit("missing").alias("rows"))
        rows.append(counted.select(F.lit(name).alias("file_name"), "rows"))
    return reduce(DataFrame.unionByName, rows).orderBy("file_name")


def missing_counts(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Nulls per column, most first: one aggregate, then one small unpivot."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    report = totals.unpivot([], df.columns, "column_name", "missing")
    if only_missing:
        report = report.filter(F.col("missing") > 0)
    return report.orderBy(F.desc("missing"), "column_name")


