"""Structured Streaming: each micro-batch is applied once under its number; windows over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental(spark: SparkSession, source: str, schema, out: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """New files of `source` as Parquet under `out`, one folder a batch; the number of batches run.

    A batch that runs again after a failure overwrites its own folder, so nothing counts twice.
    """
    seen = []

    def apply(batch: DataFrame, number: int) -> None:
        (change(batch) if change else batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
        seen.append(number)

    query = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(seen)


def event_windows(events: DataFrame, width: str = "1 day", late: str | None = None) -> DataFrame:
    """Count and sum by window and type; with `late`, a watermark of that delay for streams."""
    given = events.withWatermark("ts", late) if late else events
    out = given.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    out = events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), "n")
