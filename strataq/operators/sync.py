"""Synchronisation with a table service: changes, request batches, sending, pulling, applying changes to a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compared(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """key, op (insert, delete, update, same), content_hash. Both: key, content_hash; a null hash is a value like others."""
    side = lambda df, name: df.select(F.col(key), F.struct("content_hash").alias(name))
    both = side(new, "new").join(side(old, "old"), key, "full_outer")
    op = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").when(F.col("new.content_hash").eqNullSafe(F.col("old.content_hash")), "same").otherwise("update")
    return both.select(key, op.alias("op"), F.coalesce("new", "old")["content_hash"].alias("content_hash"))


def changes(current: DataFrame, previous: DataFrame, key: str = "doc_id", content: str = "text") -> DataFrame:
    """key, op, content_hash: insert, update or delete; rows that are the same are left out. A null content isn't an empty one."""
    hashed = lambda df: df.select(key, F.md5(content).alias("content_hash"))
    return compared(hashed(current), hashed(previous), key).where("op <> 'same'")


def batches(changed: DataFrame, size: int = 100, lanes: int | None = None, key: str = "doc_id", rows_a_lane: int = 10_000) -> DataFrame:
    """`lane` and `batch_no` of each change: lanes (by a hash, as many as rows ask for) number their batches apart, so no window spans all."""
    lanes = lanes or max(1, -(-changed.count() // rows_a_lane))
    lane = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 12), 16, 10).cast("bigint") % lanes
    at = F.row_number().over(Window.partitionBy("lane").orderBy(key))
    return changed.withColumn("lane", lane).withColumn("batch_no", F.floor((at - 1) / size).cast("bigint"))


def send(batched: DataFrame, path: str, mode: str = "append", write_id: str | None = None) -> None:
    """Changes with `lane` and `batch_no` to the service: a lane's batches are requests one after the other, lanes go at once.

    Sent again under the same `write_id` they count once; without one each send counts.
    """
    ordered = batched.repartition("lane").sortWithinPartitions("lane", "batch_no", "doc_id")
    to = ordered.write.format("table_service").option("path", path).option("batch_by", "lane,batch_no").mode(mode)
    (to.option("write_id", write_id) if write_id else to).save()


def pulled(remote: DataFrame, local: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, content_hash, op: the local snapshot after the remote rows (key, content_hash) were taken over; rows that only local had are gone."""
    return compared(remote, local, key).where("op <> 'delete'")


def applied(previous: DataFrame, current: DataFrame, changed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The next snapshot: `previous` without deleted and updated rows, and the new rows of `current`."""
    kept = previous.join(changed.where("op <> 'insert'").select(key), key, "left_anti")
    return kept.unionByName(current.join(changed.where("op <> 'delete'").select(key), key, "left_semi"))
