"""Writers. Tables are versioned folders or catalog tables; every write can leave an audit row."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.schemas import table_schema

PREDICTION_KEY = ("observation_date", "customer_id", "model_name", "mlflow_run_id")
PARTITIONS = ("split_name", "mlflow_run_id")
REPLACED_ON_CONFLICT = ("churn_probability", "predicted_churn_label", "churn_risk_band", "scored_at")


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def refresh_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a Parquet table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def refresh_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, options: Mapping[str, str] | None = None) -> None:
    """Truncate and append a relational table in batches."""
    writer = df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
    writer = writer.option("truncate", True).option("batchsize", batch_size)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save()


def merged(
    old: DataFrame, new: DataFrame, key: Sequence[str] = PREDICTION_KEY, replaced: Sequence[str] = REPLACED_ON_CONFLICT
) -> DataFrame:
    """Old rows, new rows, and for keys in both the new values of ``replaced`` with all else kept."""
    marked_old = old.withColumn("_old", F.lit(True))
    incoming = new.select(*key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in old.columns if c not in key])
    joined = marked_old.join(incoming, list(key), "full_outer")

    def column(c: str) -> Column:
        if c in key:
            return F.col(c)
        if c in replaced:
            return F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c)

    return joined.select(*[column(c) for c in old.columns])


def upsert_predictions(spark: SparkSession, new: DataFrame, root: str) -> str:
    """Merge predictions into a versioned Parquet table and return the new version's path.

    Partitions are split and run, so a new run rewrites nothing of the runs before it, and a reader of one run opens no
    file of another. A version holds only the partitions that the new rows name; a pointer lists which version each
    partition is read from, so the files of all others stay where they are. Pointers are numbered and each is renamed into place only where
    none of its number exists: of two writers that started from the same pointer one fails and none of the other's
    rows are lost. A lost executor or a failed job leaves the old pointer in force. Every writer claims a version
    number of its own before it writes; numbers of failed writers are passed over. Versions that neither the new nor the
    former pointer names are removed.
    """
    stamped = new.withColumn("scored_at", F.coalesce(F.col("scored_at"), F.current_timestamp()))
    current = current_version(spark, root)
    before, pointer = _pointer(spark, root)
    number = 1 + max([-1 if current is None else int(current.rsplit("=", 1)[1]), *_claims(spark, f"{root}/_claims")])
    target = f"{root}/version={number:08d}"
    _claim(spark, f"{root}/_claims/{number:08d}")
    rows = stamped
    if pointer:
        # One row per partition of the new rows; the filter prunes the others' folders.
        touched = stamped.select(*[F.col(c).cast("string") for c in PARTITIONS]).distinct().collect()
        named = F.struct(*PARTITIONS).isin([F.struct(*map(F.lit, pair)) for pair in touched])
        rows = merged(_read_pointer(spark, root, pointer).filter(named), stamped)
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema("churn_prediction").fields])
    typed.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(target)
    if current_version(spark, root) != current:
        raise RuntimeError(f"Another writer has replaced {current}; the new rows were not merged")
    written = [f"{outer}/{inner}" for outer in _folders(spark, target) for inner in _folders(spark, f"{target}/{outer}")]
    parts = {**pointer.get("partitions", {}), **dict.fromkeys(written, target)}
    _publish(spark, root, before + 1, json.dumps({"version": target, "partitions": parts}))
    _remove_versions(spark, root, keep={target, current, *parts.values(), *pointer.get("partitions", {}).values()})
    return target


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _claims(spark: SparkSession, folder: str) -> list[int]:
    files, target = _file_system(spark, folder)
    return [int(s.getPath().getName()) for s in files.listStatus(target)] if files.exists(target) else []


def _claim(spark: SparkSession, path: str) -> None:
    """Create the file; fail if it exists."""
    files, target = _file_system(spark, path)
    try:
        files.create(target, False).close()
    except Exception as error:
        raise RuntimeError(f"Another writer claimed {path}") from error


def _remove_versions(spark: SparkSession, root: str, keep: set[str | None]) -> None:
    files, target = _file_system(spark, root)
    names = {k.rsplit("/", 1)[1] for k in keep if k}
    for status in files.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("version=") and name not in names:
            files.delete(status.getPath(), True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    files, target = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]


def _pointer(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The number and content of the pointer in force; -1 and nothing where there is none."""
    number = max(_claims(spark, f"{root}/_pointers"), default=-1)
    if number < 0:
        return -1, {}
    return number, json.loads(spark.read.text(f"{root}/_pointers/{number:08d}", wholetext=True).first().value)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The path of the version written last."""
    return _pointer(spark, root)[1].get("version")


def _read_pointer(spark: SparkSession, root: str, pointer: dict) -> DataFrame:
    """The partitions that a pointer names, each from its version, in one scan however many versions there are."""
    schema = table_schema("churn_prediction")
    paths = [f"{version}/{name}" for name, version in sorted(pointer["partitions"].items())]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(schema.fieldNames())


def read_predictions(spark: SparkSession, root: str) -> DataFrame:
    pointer = _pointer(spark, root)[1]
    return _read_pointer(spark, root, pointer) if pointer else spark.createDataFrame([], table_schema("churn_prediction"))


def _publish(spark: SparkSession, root: str, number: int, text: str) -> None:
    """Write a pointer aside and rename it into place; fail if its number is taken."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    files, fresh = _file_system(spark, f"{root}/_staged/{uuid.uuid4().hex}")
    stream = files.create(fresh, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    target = hadoop.Path(f"{root}/_pointers/{number:08d}")
    files.mkdirs(target.getParent())
    never_over = sc._gateway.new_array(hadoop.Options.Rename, 1)
    never_over[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(files.getUri(), sc._jsc.hadoopConfiguration()).rename(fresh, target, never_over)
    except Exception as error:
        raise RuntimeError(f"Another writer has published {target}; the new rows were not merged") from error


def write_json_report(report: DataFrame, path: str) -> None:
    """A report of one nested row as JSON."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_records(df: DataFrame) -> DataFrame:
    """Rows as JSON text: decimals as doubles at any depth of the top level, dates as ISO text, nulls kept."""
    def plain(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DecimalType):
            return F.transform(f.name, lambda x: x.cast("double")).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return F.nanvl(F.col(f.name), F.lit(None)).alias(f.name)
        return F.col(f.name)

    fields = [plain(f) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))


def audit_row(
    spark: SparkSession, batch_id: str, mode: str, counts: Mapping[str, Any], status: str = "SUCCEEDED", error: str | None = None,
    started: dt.datetime | None = None, finished: dt.datetime | None = None,
) -> DataFrame:
    """One row of the load audit table. ``counts`` gives seed, n_customers and the history dates."""
    values = {
        "batch_id": batch_id, "run_started_at": started, "run_finished_at": finished, "generation_mode": mode,
        "status": status, "error_message": error, "created_by": "holdfast", **counts,
    }
    schema = table_schema("generation_batch")
    row = spark.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    return row.withColumns({
        "run_started_at": F.coalesce("run_started_at", F.current_timestamp()),
        "run_finished_at": F.coalesce("run_finished_at", F.when(F.lit(status != "STARTED"), F.current_timestamp())),
    })


def append_audit(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)
