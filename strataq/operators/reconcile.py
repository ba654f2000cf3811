"""Reconciliation of two sides by digests of key ranges.

Each side keeps its rows sorted by a hash of the key, and a tree of digests over equal ranges of that
hash, 16 children a node. Comparing starts at the roots and goes down only where digests differ, so what is read
of either side grows with the changes, not with the table. A digest is a count and sums of hashes of rows, so
it is a partial sum and needs no order.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.sources import complete

from .sync import compared

BITS, MOST_NODES, MOST_RANGES = 48, 1024, 64
_SUMS = ("n", "s1", "s2", "s3", "s4")


def _sums(key: str) -> list[Column]:
    halves = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.coalesce("content_hash", F.lit("null")), F.col("content_hash").isNull())
        halves += [F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(0xFFFFFFFF))]
    return [c.alias(n) for n, c in zip(_SUMS, (F.count(F.lit(1)), *halves), strict=True)]


def keep(rows: DataFrame, path: str, key: str = "doc_id", content: str = "text", depth: int | None = None, mode: str = "error") -> None:
    """Writes the rows (key, content_hash, place) sorted by place, and the digests of all levels, under `path`.

    depth: 16^depth ranges at the bottom; else of about 1,000 rows each. Null contents are values of their own, keys are unique and not null.
    """
    place = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, BITS // 4), 16, 10).cast("bigint")
    placed = rows.select(F.col(key), F.md5(content).alias("content_hash"), place.alias("place"))
    placed.repartitionByRange("place").sortWithinPartitions("place").write.mode(mode).option("parquet.block.size", 4 << 20).parquet(f"{path}/rows")
    spark = rows.sparkSession
    kept = spark.read.parquet(f"{path}/rows")
    depth = max(1, math.ceil(math.log(max(1, kept.count()) / 1000, 16))) if depth is None else depth
    now = kept.groupBy(F.shiftright("place", BITS - 4 * depth).alias("node")).agg(*_sums(key))
    for level in range(depth, -1, -1):
        now.repartitionByRange("node").sortWithinPartitions("node").write.mode(mode).parquet(f"{path}/level-{level}")
        now = spark.read.parquet(f"{path}/level-{level}").groupBy(F.shiftright("node", 4).alias("node")).agg(*[F.sum(s).alias(s) for s in _SUMS])


def _in_ranges(column: str, ranges: list[tuple[int, int]]) -> Column:
    """A balanced `or` of ranges, which the scan gets to skip what lies between."""
    tests = [F.col(column).between(a, b) for a, b in ranges]
    while len(tests) > 1:
        tests = [reduce(lambda x, y: x | y, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0] if tests else F.lit(False)


def _ranges(nodes: list[int], width: int, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all nodes, each `width` wide; where there are more, the smallest gaps are closed."""
    out = [(n * width, n * width + width - 1) for n in nodes]
    gaps = sorted((b[0] - a[1], i) for i, (a, b) in enumerate(zip(out, out[1:], strict=False)))
    cuts = {i for _, i in gaps[max(0, len(gaps) - most + 1) :] if out[i + 1][0] - out[i][1] > 1}
    found, start = [], 0
    for i in range(len(out)):
        if i in cuts or i + 1 == len(out):
            found.append((out[start][0], out[i][1]))
            start = i + 1
    return found


def differing(spark: SparkSession, one: str, other: str) -> tuple[int, list[int], list[int]]:
    """The deepest level reached, its nodes that differ, and how many nodes were compared at each level.

    Levels that both sides keep are compared. Going down ends where more nodes differ than the driver should hold (1,024): from there on ranges are wide, but whole.
    """
    nodes, counts, level = [0], [], 0
    while all(complete(spark, f"{path}/level-{level}") for path in (one, other)):
        there = _in_ranges("node", _ranges(nodes, 16) if level else [(0, 0)])
        side = lambda path: spark.read.parquet(f"{path}/level-{level}").where(there)  # noqa: B023, E731
        both = side(one).select("node", F.struct(*_SUMS).alias("a")).join(side(other).select("node", F.struct(*_SUMS).alias("b")), "node", "full_outer")
        counts.append(both.count())
        found = [r.node for r in both.where(~F.col("a").eqNullSafe(F.col("b"))).select("node").orderBy("node").limit(MOST_NODES + 1).collect()]
        if not found or len(found) > MOST_NODES:
            return (level, [], counts) if not found else (max(0, level - 1), nodes, counts)
        nodes, level = found, level + 1
    return level - 1, nodes, counts


def reconciled(spark: SparkSession, current: str, previous: str, key: str = "doc_id") -> DataFrame:
    """key, op, content_hash as `sync.changes` has them, from two sides that `keep` wrote."""
    level, nodes, _ = differing(spark, current, previous)
    inside = _in_ranges("place", _ranges(nodes, 1 << (BITS - 4 * level)))
    side = lambda path: spark.read.parquet(f"{path}/rows").where(inside).select(key, "content_hash")
    return compared(side(current), side(previous), key).where("op <> 'same'")
