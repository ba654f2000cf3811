"""Connected components by alternating stars (Kiveris et al., 2014), all state in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root of each node of `edges` (u, v: long) that isn't the least of its component.

    Each round joins every node to the least of its neighbours; minima are partial sums, so a node
    that a third of all edges meet costs a row a task, and edges are distinct after each round.
    Self-loops and repeated edges do no harm; no edges, no rows.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        now = written(after.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
