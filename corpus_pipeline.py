"""The corpus pipeline: language ID, exact and near de-duplication, mixing, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lumenframe.llm import exact_dedup, language_id, mixing, near_dedup, packing
from lumenframe.llm.base import new_path, scratch


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: with a letter, and no costlier than any language."""
    # Whole documents go through Python when the caller writes the result: a few at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 of their five-word shingles the document with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: a document taken twice is two rows."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, each window in the sources' proportions."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", identify), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

# Packing follows a tokenizer, so SQL can't give run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, applied to the table ``documents``: pieces of packed sequences.

    Each stage's output is written and read again. What a stage has staged for itself and the
    output before it are deleted then, so the disk holds one stage at a time. Rows count, not ids:
    null, repeated and equal ids do no harm, null and empty texts go with the first stage, and an
    empty table gives no piece. Further columns pass through whatever their names.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        with scratch(spark) as made:
            stage(spark, docs, sf_dir).write.parquet(path)
            made += before
        docs, before = spark.read.parquet(path), [path]
    return docs
