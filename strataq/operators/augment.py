"""Augmentation: variants of each question with their lineage, and splits that keep families together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.functions import in_sample, normalised

from .review import with_ids


def variants(pairs: DataFrame) -> DataFrame:
    """question_id, parent_id, variant_no, kind, question: one row per transform, no shuffle."""
    q = F.col("question")
    made = {"lower": F.lower(q), "plain": normalised(q), "cued": F.concat(F.lit("Please answer: "), q), "short": F.substring(q, 1, 120)}
    rows = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("variant_no"), F.lit(k).alias("kind"), x.alias("question")) for i, (k, x) in enumerate(made.items())])
    out = with_ids(pairs).select(F.col("question_id").alias("parent_id"), F.explode(rows).alias("v")).select("parent_id", "v.*")
    return out.withColumn("question_id", F.md5(F.concat_ws("|", "parent_id", F.col("variant_no").cast("string"))))


def with_lineage(pairs: DataFrame) -> DataFrame:
    """Seeds and variants in one table."""
    seed = with_ids(pairs).select("question_id", F.lit(None).cast("string").alias("parent_id"), F.lit(0).cast("bigint").alias("variant_no"), F.lit("seed").alias("origin"), "question")
    more = variants(pairs).select("question_id", "parent_id", "variant_no", F.lit("augmented").alias("origin"), "question")
    return seed.unionByName(more)


def split(questions: DataFrame, test_share_of_65536: int = 6554) -> DataFrame:
    """question_id, part: a family is wholly in one part, whatever the partitioning."""
    family = F.coalesce("parent_id", "question_id")
    return questions.select("question_id", F.when(in_sample(family, test_share_of_65536), "test").otherwise("train").alias("part"))
