"""The harness's loop: a parsed answer decides what is asked next, until each question is settled.

A round asks for every open question once. State, ledger and answers of each round are tables of
their own, so lineage ends with each and a run that was killed goes on from its last whole table. The ledger is
written before the calls that it pays for: what a killed run had asked stays charged, is charged again when
asked again, and calls never exceed the ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.sources import complete, exists

from .agent import parsed_answer

Ask = Callable[[DataFrame], DataFrame]
Decide = Callable[[Column, Column], Column]
_BUCKETS = 4096
_LEDGER = "question_id string, round int, price bigint"


def by_score(accept: int = 67, give_up: int = 10) -> Decide:
    """Accept at a score, give up under another, else revise to the answer's question; an answer that can't be read is asked for again."""

    def decide(body: Column, draft: Column) -> Column:
        r = parsed_answer(body)
        decision = F.when(r["score"] >= accept, "accepted").when(r["score"] < give_up, "given_up").otherwise("open")
        return F.struct(decision.alias("status"), F.when(decision == "open", F.coalesce(r["question"], draft)).otherwise(draft).alias("draft"))

    return decide


def recorded(answers: DataFrame) -> Ask:
    """Answers from a table (question_id, round, body) in place of a model; a request without one stays unanswered."""
    return lambda asked: asked.join(answers.select("question_id", "round", "body"), ["question_id", "round"]).select("request_id", "body")


def _within(open_: DataFrame, left: int) -> DataFrame:
    """Of `open_` (question_id, price) as many, in the order of a hash, as `left` pays for: bucket sums first, so no window spans all."""
    hashed = open_.withColumn("bucket", F.pmod(F.xxhash64("question_id"), F.lit(_BUCKETS)))
    sums = hashed.groupBy("bucket").agg(F.sum("price").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("price").over(Window.partitionBy("bucket").orderBy("question_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    upto = hashed.join(sums.select("bucket", before.alias("before")), "bucket").withColumn("upto", F.col("before") + inside)
    return upto.where(F.col("upto") <= left).select(open_.columns)


def refine(spark: SparkSession, questions: DataFrame, path: str, ask: Ask, decide: Decide, price: Callable[[Column], Column], budget: int, most_rounds: int = 8, total: int | None = None) -> DataFrame:
    """question_id, status, rounds, spent, draft of each question (question_id: string and unique; draft).

    status: accepted, given_up, unanswered (no answer came), over_budget (its next call would take its ledger over `budget`, or all
    ledgers over `total`), or open after `most_rounds`. ask: request_id, question_id, round, payload to request_id, body.
    decide: body and draft to a struct of status (accepted, given_up or open) and the next draft. spent: all that the ledger
    charged. A null draft costs and asks as an empty one; no questions, no rows.
    """
    state = lambda r: f"{path}/state-{r}"
    if not complete(spark, state(0)):
        questions.select(F.col("question_id").cast("string").alias("question_id"), F.lit("open").alias("status"), F.lit(0).alias("rounds"), F.coalesce("draft", F.lit("")).alias("draft")).write.mode("overwrite").parquet(state(0))
    r = 0
    while complete(spark, state(r + 1)):
        r += 1
    ledger = lambda: spark.read.schema(_LEDGER).parquet(f"{path}/ledger") if exists(spark, f"{path}/ledger") else spark.createDataFrame([], _LEDGER)
    while r < most_rounds:
        now = spark.read.parquet(state(r))
        open_ = now.where("status = 'open'")
        if open_.isEmpty():
            break
        key = F.md5(F.concat_ws("|", "question_id", F.lit(r + 1).cast("string"), F.md5("draft")))
        answers = f"{path}/answers-{r + 1}"
        if not complete(spark, answers):
            paid = ledger()
            spent = paid.groupBy("question_id").agg(F.sum("price").alias("spent"))
            due = open_.select("question_id", "draft", price(F.col("draft")).cast("bigint").alias("price")).join(spent, "question_id", "left").where(F.coalesce("spent", F.lit(0)) + F.col("price") <= budget).select("question_id", "draft", "price")
            if total is not None:
                due = _within(due, total - (paid.agg(F.sum("price")).first()[0] or 0))
            due.write.mode("overwrite").parquet(f"{path}/due-{r + 1}")
            due = spark.read.parquet(f"{path}/due-{r + 1}")
            due.select("question_id", F.lit(r + 1).alias("round"), "price").write.mode("append").parquet(f"{path}/ledger")
            asked = due.select(key.alias("request_id"), "question_id", F.lit(r + 1).alias("round"), F.col("draft").alias("payload"))
            asked.select("request_id").join(ask(asked), "request_id", "left").select("request_id", "body").write.mode("overwrite").parquet(answers)
        got = spark.read.schema("request_id string, body string").parquet(answers).groupBy("request_id").agg(F.max("body").alias("body"), F.lit(True).alias("asked"))
        met = open_.withColumn("request_id", key).join(got, "request_id", "left").withColumn("next", decide(F.col("body"), F.col("draft")))
        status = F.when(F.col("asked").isNull(), "over_budget").when(F.col("body").isNull(), "unanswered").otherwise(F.col("next.status"))
        moved = met.select("question_id", status.alias("status"), (F.col("rounds") + F.when(F.col("asked"), 1).otherwise(0)).alias("rounds"), F.when(F.col("body").isNull(), F.col("draft")).otherwise(F.col("next.draft")).alias("draft"))
        now.where("status <> 'open'").unionByName(moved).write.mode("overwrite").parquet(state(r + 1))
        r += 1
    spent = ledger().groupBy("question_id").agg(F.sum("price").alias("spent"))
    return spark.read.parquet(state(r)).join(spent, "question_id", "left").select("question_id", "status", "rounds", F.coalesce("spent", F.lit(0)).alias("spent"), "draft")
