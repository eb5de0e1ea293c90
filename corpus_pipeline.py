"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import line_dedup, packing, quality_model, simhash, suffix_dedup
from holdfast.llm.common import read_table
from holdfast.session import ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier does not reject, with all their columns.

    A null text or one without words is rejected; equal texts are judged alike and repeated rows stay; an empty table
    gives no rows. Without labels the votes alone decide.
    """
    return quality_model.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share; blank lines and null texts stay as they are.

    Repeated rows are treated alike; an empty table gives no rows.
    """
    return line_dedup.remove_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash (four-word shingles, at most four bits apart): the
    smallest id, a null id last. Repeated rows count as one.

    Texts without words, null ones too, are one group; an empty table gives no rows.
    """
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier document has; a character cut in part goes whole.

    A null text stays null and removes nothing; of repeated rows the first of their ids keeps the passage, equal ids keep
    it all. Columns of any name stay as they are. An empty table gives no rows.
    """
    others = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c != "text"]  # the text goes once through every step
    cut = suffix_dedup.remove_repeats(docs.select("doc_id", "text", F.struct(*others).alias("row")))
    text = F.when(F.col("text").isNull() | (F.col("n_removed") == 0), F.col("text")).otherwise(suffix_dedup.whole_characters(F.col("kept")))
    return cut.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 4096.

    A null or empty text has its end id alone; repeated rows are packed one by one; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack_sequences),
]

#: Classifier, fingerprints and suffix sorting can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/holdfast-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
