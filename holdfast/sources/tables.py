"""Table readers: declared CSV, Parquet, JDBC, parameterised SQL and the calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.schemas import TABLE_NAMES, table_schema


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a local, shared or object-store path exists (a driver metadata call)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Header CSV with the declared columns; an empty field is null, a malformed row fails."""
    return (
        spark.read.schema(table_schema(table)).option("header", True).option("nullValue", "")
        .option("enforceSchema", False).option("mode", "FAILFAST").option("multiLine", False).csv(path)
    )


def read_csv_folder(spark: SparkSession, folder: str, tables: Sequence[str] = TABLE_NAMES) -> dict[str, DataFrame]:
    """Every declared table that has a file; a missing file is skipped, a missing folder is an error."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(folder)
    return {t: read_csv(spark, f"{folder}/{t}.csv", t) for t in tables if path_exists(spark, f"{folder}/{t}.csv")}


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}")


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, partition_column: str, lower: Any, upper: Any, partitions: int,
    fetch_size: int = 10000, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational table or ``(query) alias``, read in ``partitions`` ranges of a numeric or date column.

    The column, its least and greatest value and the number of ranges must be given: without them the whole table would
    be read by one task. Values outside the bounds are read too, with the first and last range; nulls with the first.
    """
    if partitions < 2:
        raise ValueError("partitions must be at least 2")
    reader = (
        spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
        .option("partitionColumn", partition_column).option("lowerBound", str(lower)).option("upperBound", str(upper))
        .option("numPartitions", partitions)
    )
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def select_in(
    spark: SparkSession, view: str, column: str, values: Sequence[Any], order_by: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """Rows whose column is in a list of any length; values bind as parameters, never as text."""
    marks = ", ".join(f":v{i}" for i in range(len(values)))
    rows = spark.sql(
        f"SELECT * FROM IDENTIFIER(:view) WHERE IDENTIFIER(:column) IN ({marks})",
        args={"view": view, "column": column, **{f"v{i}": v for i, v in enumerate(values)}},
    )
    if order_by:
        rows = rows.orderBy(*order_by)
    return rows if limit is None else rows.limit(limit)


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """The calendar dimension, one row per day."""
    d = F.col("calendar_date")
    month_end = F.last_day(d) == d
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("calendar_date"))
    return days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"), d,
        F.year(d).alias("calendar_year"), F.quarter(d).alias("calendar_quarter"), F.month(d).alias("calendar_month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"), F.weekofyear(d).alias("week_of_year"), (F.weekday(d) >= 5).alias("is_weekend"),
        month_end.alias("is_month_end"), (month_end & (F.month(d) % 3 == 0)).alias("is_quarter_end"),
        (month_end & (F.month(d) == 12)).alias("is_year_end"),
    )


def column_catalog(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) of every column."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
