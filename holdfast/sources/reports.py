"""Readers of the report files that jobs save."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from holdfast.schemas import DRIFT_REPORT_SCHEMA, SHAP_SUMMARY_SCHEMA
from holdfast.sources.tables import path_exists


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved CSV report; an absent path gives an empty frame of the same schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_drift_report(spark: SparkSession, path: str) -> DataFrame:
    return read_report(spark, path, DRIFT_REPORT_SCHEMA)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """The whole report in rank order."""
    return read_report(spark, path, SHAP_SUMMARY_SCHEMA).orderBy("rank")
