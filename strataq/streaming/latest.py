"""Changes applied as they come: a record's last version wins, whatever order and how often they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

COLUMNS = "key string, version bigint, at timestamp, op string, content string"
_OUT = "key string, version bigint, op string, content string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Latest(StatefulProcessor):
    """A key's greatest (version, op, content); a deleted key is forgotten when the watermark is `keep_ms` past its delete."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", "version bigint, op string, content string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, until = None, 0
        for part in rows:
            top = part[part["version"] == part["version"].max()]
            for version, at, op, content in zip(top["version"], top["at"], top["op"], top["content"], strict=True):
                content = None if pd.isna(content) else content
                rank = (int(version), op, content is not None, content or "")
                if best is None or rank > best[0]:
                    best, until = (rank, content), int(at.timestamp() * 1000) + self.keep_ms
        held = self.held.get()
        if best and (held is None or best[0] > (held[0], held[1], held[2] is not None, held[2] or "")):
            (version, op, *_), content = best
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if op == "delete":
                self.handle.registerTimer(until)
            self.held.update((version, op, content))
            yield pd.DataFrame({"key": [key[0]], "version": [version], "op": [op], "content": pd.Series([content], dtype=object)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def apply_changes(spark: SparkSession, source: str, out: str, checkpoint: str, late: str = "1 day", keep_ms: int = 86_400_000) -> None:
    """New files of changes (`COLUMNS`) at `source` into the log at `out`: a folder a batch, with the keys whose last version it changed.

    Changes come in any order and more than once; equal versions go by greatest op, then content. Those older than the watermark (greatest `at` less
    `late`) are dropped, so a delete that is forgotten can't be undone by an older change unless that is stamped later. Changes without version or
    time are left out; a null op is `upsert`. Runs till no file is left and goes on from the checkpoint; a batch that runs again overwrites its folder.
    State is kept in RocksDB, which this kind of state asks for; the session's own choice is put back.
    """
    given = spark.readStream.schema(COLUMNS).parquet(source).where("version is not null and at is not null").fillna("upsert", ["op"])
    kept = given.withWatermark("at", late).groupBy("key").transformWithStateInPandas(_Latest(keep_ms), _OUT, "Update", "EventTime")
    log = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _STORE)
    try:
        kept.writeStream.foreachBatch(log).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)


def current_rows(spark: SparkSession, out: str) -> DataFrame:
    """key, version, content: the records that stand after the log's batches."""
    last = spark.read.schema(_OUT).parquet(f"{out}/*").groupBy("key").agg(F.max(F.struct("version", "op", "content")).alias("r"))
    return last.where("r.op <> 'delete'").select("key", "r.version", "r.content")
