"""The agent harness: requests, pending work, calls through a client, parsed responses.

A call may cost and may differ each time, so it is marked nondeterministic, made once per
request id, and its responses are written before anything reads them.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataq.sources import exists

Client = Callable[[str, str], str]
RESPONSE = "score int, question string"
ANSWER = "request_id string, status string, body string, error string, attempt int"


def stub_client(stage: str, payload: str) -> str:
    """A deterministic stand-in for a model: every 13th answer is malformed."""
    h = int(hashlib.md5(f"{stage}|{payload}".encode()).hexdigest()[:8], 16)
    if h % 13 == 0:
        return "sorry"
    return json.dumps({"score": h % 100, "question": f"Q{h % 1000}"})


def requests(rows: DataFrame, stage: str, version: str, payload: str) -> DataFrame:
    """request_id, stage, payload of each distinct payload."""
    text = F.col(payload)
    return rows.select(F.md5(F.concat_ws("|", F.lit(stage), F.lit(version), F.md5(text))).alias("request_id"), F.lit(stage).alias("stage"), text.alias("payload")).dropDuplicates(["request_id"])


def pending(wanted: DataFrame, answered: DataFrame) -> DataFrame:
    return wanted.join(answered.select("request_id"), "request_id", "left_anti")


def call(todo: DataFrame, client: Client = stub_client, tries: int = 1, wait: float = 0.5) -> DataFrame:
    """request_id, status, body, error, attempt. A failing call is tried again after a wait that doubles,
    then it is a row with status `failed`. `attempt` counts on from that of `todo`, if it has one."""
    schema = T.StructType([T.StructField("status", T.StringType()), T.StructField("body", T.StringType()), T.StructField("error", T.StringType()), T.StructField("tries", T.IntegerType())])

    def one(stage: str, payload: str) -> tuple:
        for i in range(1, tries + 1):
            try:
                return "done", client(stage, payload), None, i
            except Exception as e:
                error = str(e)[:200]
                if i < tries:
                    time.sleep(wait * 2 ** (i - 1))
        return "failed", None, error, tries

    @F.pandas_udf(schema)
    def ask(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for stages, payloads in parts:
            out = [one(stage, payload) for stage, payload in zip(stages, payloads, strict=True)]
            yield pd.DataFrame(out, columns=["status", "body", "error", "tries"])

    before = F.col("attempt") if "attempt" in todo.columns else F.lit(0)
    asked = todo.select("request_id", before.alias("before"), ask.asNondeterministic()("stage", "payload").alias("r"))
    return asked.select("request_id", "r.status", "r.body", "r.error", (F.col("before") + F.col("r.tries")).cast("int").alias("attempt"))


def latest(responses: DataFrame) -> DataFrame:
    """One row a request: its last answer that is done, else its last attempt."""
    best = responses.groupBy("request_id").agg(F.max(F.struct(F.col("status") == "done", "attempt", "status", "body", "error")).alias("r"))
    return best.select("request_id", "r.status", "r.body", "r.error", "r.attempt")


def run_stage(spark: SparkSession, wanted: DataFrame, path: str, client: Client = stub_client, tries: int = 1, most_attempts: int = 10) -> DataFrame:
    """The last response of each request at `path`, after asking for those without one that is done.

    A rerun asks for nothing twice but what failed, and for that until `most_attempts`.
    """
    todo = wanted
    if exists(spark, path):
        last = latest(spark.read.schema(ANSWER).parquet(path))
        counts = last.select("request_id", "attempt")
        todo = pending(wanted, last.where((F.col("status") == "done") | (F.col("attempt") >= most_attempts))).join(counts, "request_id", "left").fillna(0, ["attempt"])
    call(todo, client, tries).write.mode("append").parquet(path)
    return latest(spark.read.schema(ANSWER).parquet(path))


def parsed_answer(body: Column) -> Column:
    """score and question of an answer's body, null where it has none."""
    return F.from_json(body, RESPONSE, {"mode": "PERMISSIVE"})


def parsed(responses: DataFrame) -> DataFrame:
    """request_id, ok, score, question: malformed bodies are kept apart as not ok."""
    r = parsed_answer(F.col("body"))
    return responses.select("request_id", r.alias("r")).select("request_id", F.coalesce(F.col("r.score").isNotNull(), F.lit(False)).alias("ok"), "r.score", "r.question")


def seeds(docs: DataFrame, k: int = 3) -> DataFrame:
    """The k longest documents of each source; ranks are cut before the shuffle too."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.col("n_chars").desc(), "doc_id"))
    return docs.select("doc_id", "source", "n_chars", rank.cast("bigint").alias("rank")).where(F.col("rank") <= k)
