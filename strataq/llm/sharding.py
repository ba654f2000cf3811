"""Rendezvous sharding: each key goes to the shard whose hashed, weighted score is least.

DataFrame functions only. A row's shard follows from its key and the shards' weights alone,
so one more shard takes rows only into itself, and a heavier shard draws in proportion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_text, let, md5_int, of_row, with_row

_SPAN = float(1 << 48)


def _score(key: Column, shard: Column, weight: Column) -> Column:
    u = (md5_int(F.concat(key, F.lit(":"), shard.cast("string"))) + F.lit(0.5)) / F.lit(_SPAN)
    return -F.log(u) / weight


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], grown_by: Sequence[float] = (1.0,), shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """`df` with its shard, and its shard after growth. No shuffle.

    A null key is a key like any other. Repeated rows share a shard. Columns of `df` named as
    the two new ones are replaced, all others stay whatever their names; an empty table stays empty.
    """
    n = len(weights)
    name, every = key_text(F.col(f"`{key}`")), F.array(*[F.lit(float(w)) for w in (*weights, *grown_by)])
    if not n or min((*weights, *grown_by)) <= 0:
        raise ValueError("weights must be positive, and one at least")

    def least(k: Column, lo: int, hi: int) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(lo), F.lit(hi - 1)), lambda s: F.struct(_score(k, s, every[s]).alias("score"), s.alias("s"))))

    placed = let(name, lambda k: let(least(k, 0, n), lambda now: F.struct(now["s"].alias("now"), (F.array_min(F.array(now, least(k, n, n + len(grown_by))))["s"] if grown_by else now["s"]).alias("then"))))
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in (shard, grown)])
    return with_row(df, placed=placed).select(*of_row(rest), F.col("placed.now").alias(shard), F.col("placed.then").alias(grown))


def number_slots(records: DataFrame, key: str, shard: str = "shard", slot: str = "slot", buckets: int = 1024) -> DataFrame:
    """Gapless numbers from 0 within each shard, by the key's hash, then by all other columns.

    Equal records are counted before any shuffle and numbered as a block, so a key that holds a
    third of the rows costs one row a task; each shard is numbered in `buckets` ranges of the
    hash whose offsets are prefix sums over a table of at most shards times buckets rows.
    """
    columns = [c for c in records.columns if c != slot]
    # columns by position, so that their names can't clash with the helpers'
    keyed = records.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], md5_int(key_text(F.col(f"`{key}`")), 8).alias("hash"))
    home = f"c{columns.index(shard)}"
    blocks = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", F.floor(F.col("hash") * buckets / float(1 << 32)).cast("int"))
    order = [F.col("hash"), *[F.col(f"c{i}").asc_nulls_first() for i, c in enumerate(columns) if c != shard]]
    within = Window.partitionBy(home, "bucket").orderBy(*order)
    sums = blocks.groupBy(home, "bucket").agg(F.sum("n").alias("sum"))
    starts = sums.select(home, "bucket", (F.sum("sum").over(Window.partitionBy(home).orderBy("bucket")) - F.col("sum")).alias("start"))
    placed = blocks.withColumn("before", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    numbered = placed.join(F.broadcast(starts), [home, "bucket"]).withColumn("first", F.col("start") + F.col("before"))
    step = 4096  # copies are written out in two steps, so no array is longer than this
    out = numbered.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / step))))
    out = out.withColumn("inner", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(step), F.col("n") - F.col("part") * step) - 1)))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], (F.col("first") + F.col("part") * step + F.col("inner")).alias(slot))
