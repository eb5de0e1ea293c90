"""Session helpers shared by the jobs, the bench and the tests."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("holdfast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names; a fresh local one only where none is set."""
    setting, explicit = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    # Spark derives a folder below the setting; any other one was set explicitly and goes first.
    own = explicit and setting and setting.removeprefix("file:").lstrip("/") not in explicit
    named = explicit if own or not setting else setting
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="holdfast-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Up to so many parts (Spark's default of spark.shuffle.sort.bypassMergeThreshold) a shuffle writes rows straight to files; for more
#: it gathers what a task sends in that task's memory, to sort it.
STREAMED_PARTS = 200


def parts_for(rows: int, each: int, most: int) -> int:
    """Into how many parts to deal rows: some ``each`` to a part, or up to ``most`` if that keeps them at STREAMED_PARTS."""
    parts = max(1, -(-rows // each))
    return parts if parts <= STREAMED_PARTS else max(STREAMED_PARTS, -(-rows // most))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared checkpoint folder and read it back.

    It cuts the lineage, survives lost executors, and later readers scan only the columns they need. The write's shuffle
    files go when it ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/holdfast-{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
