"""Document corpus reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.text import heading
from holdfast.sources.tables import path_exists

_SCHEMA = "document_id STRING, title STRING, path STRING, text STRING"


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every non-blank Markdown or text file below the folder: file stem, title, path and whole text.

    Rows carry no global order; sort by ``path`` where an order is shown.
    """
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _SCHEMA)
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{md,txt,MD,TXT,Md,Txt}")
    # The reader gives paths percent-encoded; a plus sign in a name stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    text = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    return (
        files.select(path.alias("path"), text.alias("text")).filter(F.col("text") != "")
        .select(file_stem(F.col("path")).alias("document_id"), heading("text", file_stem(F.col("path"))).alias("title"), "path", "text")
    )


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)
