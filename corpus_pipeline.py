"""A training corpus from `documents`: quality, near-duplicates, personal data, mix, training windows.

Each stage takes all that the one before kept, as a Parquet table, and its decisions take effect. Every
stage takes nulls in any column, columns of any names beside those of documents, and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.llm.common import id_remainder, table, written
from strataq.llm.mixing import mixed_documents
from strataq.llm.neardup import one_of_each
from strataq.llm.packing import pack_documents
from strataq.llm.pii import mask_documents
from strataq.llm.quality import accepted
from strataq.llm.queries import tokenizer_path


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars as the text now has it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; null and empty texts are scored too, and without trusted positives all stay."""
    return accepted(docs, table(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) == 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, similarity 0.8) the one of the least id; texts without words and rows without an id stay."""
    return one_of_each(docs, 5, 80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data masked; a null text stays null."""
    return _sized(mask_documents(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows repeat, and one of each source is cut; null is a source, texts without words go."""
    return _sized(mixed_documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, repeats too, in windows of 2048 tokens; a null text would be its end id alone."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i + 1 == len(STAGES) else written(out, name)
    return docs
