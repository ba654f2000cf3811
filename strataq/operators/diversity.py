"""Diverse seeds: k rows such that every row is near one of them (k-centre), by composable core-sets with a proof of each result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.sources import written

_ROW = "vec_id bigint, v array<double>"


def farthest_first(ids: np.ndarray, v: np.ndarray, k: int) -> tuple[list[int], list[float], float]:
    """Places of k rows, the first of least id, each next the farthest from those before (ties to smaller ids); the squared
    distance at which each was taken; and that of the row farthest from them all. Fewer rows where all others are equal to one of them."""
    by_id = np.argsort(ids, kind="stable")
    v = v[by_id]
    near, at, taken, gaps = np.full(len(v), np.inf), 0, [], []
    while len(taken) < k and near[at] > 0:
        taken.append(at)
        gaps.append(float(near[at]))
        near = np.minimum(near, ((v - v[at]) ** 2).sum(axis=1))
        at = int(near.argmax())
    return [int(by_id[i]) for i in taken], gaps, float(near[at])


def _usable(rows: DataFrame, scale: float) -> DataFrame:
    """vec_id, v: whole numbers, so that distances and ties are the same everywhere; of the length that most rows have, the least of such lengths."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("double"))
    sound = rows.where("vec_id is not null and size(embedding) > 0 and coalesce(forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')), false)")
    lengths = sound.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.agg(F.max(F.struct("n", -F.col("size"))).alias("m")).first()["m"]
    return sound.where(F.size("embedding") == F.lit(-usual[1] if usual else 0)).select("vec_id", x.alias("v"))


def _core(rows: DataFrame, n: int, block: int, core: int) -> DataFrame:
    """At most `block` of n rows: farthest-first rows of each hashed block, and again of what these leave."""

    def best(part: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(list(part["v"]))
        return part.iloc[farthest_first(part["vec_id"].to_numpy(), v, core)[0]][["vec_id", "v"]]

    level = 0
    while n > block:
        # half-full blocks, so that chance puts few over `block`; equal vectors meet in one block, where all but one of them go
        home = F.pmod(F.xxhash64(F.lit(level), "v"), F.lit(-(-n * 2 // block)))
        rows = written(rows.groupBy("v").agg(F.min("vec_id").alias("vec_id")).select("vec_id", "v").groupBy(home).applyInPandas(best, _ROW))
        n, level = rows.count(), level + 1
    return rows


def _measured(rows: DataFrame, centres: np.ndarray, far: int) -> tuple[list, list]:
    """Of each centre how many rows are nearest to it and the largest of their squared distances; and the `far` rows farthest from all centres."""
    k = len(centres)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            v = np.stack(list(batch["v"]))
            d = np.stack([((v - c) ** 2).sum(axis=1) for c in centres])
            at, least = d.argmin(axis=0), d.min(axis=0)
            count, most = np.bincount(at, minlength=k), np.zeros(k)
            np.maximum.at(most, at, least)
            yield pd.DataFrame({"centre": np.arange(k), "n": count, "most": most, "vec_id": pd.array([None] * k, "Int64"), "v": [None] * k})
            out = np.lexsort((batch["vec_id"], -least))[:far]
            yield pd.DataFrame({"centre": -1, "n": 0, "most": least[out], "vec_id": batch["vec_id"].iloc[out].astype("Int64"), "v": list(v[out])})

    found = written(rows.mapInPandas(nearest, "centre int, n bigint, most double, vec_id bigint, v array<double>"))
    parts = found.where("centre >= 0").groupBy("centre").agg(F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("centre").collect()  # k rows
    different = found.where("centre < 0").groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.max("most").alias("most"))
    return parts, different.orderBy(F.col("most").desc(), "vec_id").limit(far).collect()


def diverse(rows: DataFrame, k: int, scale: float = 1024, block: int = 4096, core: int | None = None, slack: float = 0.0, rounds: int = 50) -> DataFrame:
    """rank, vec_id, gap2, n_rows, radius2, all_radius2, best_at_least2: k rows (vec_id, embedding) with every row near one of them.

    Blocks of rows each leave `core` rows (8k if none is given), taken farthest-first, until these fit one block; the seeds are taken from those in the
    same way (Gonzalez, 1985). Then all rows are measured. Seeds and the farthest core row are k + 1 rows at least `gap` apart, so no k centres have a radius
    under half of it: the seeds are within twice the best if no row is farther than `gap`. Where one is, the `core` farthest rows join the core and seeds
    are taken again, until no row is farther than 1 + `slack` times it, or `rounds` are over. The driver holds a block of core rows and `core` a round.

    gap2: squared distance to the seeds before (0 for the first); n_rows, radius2: rows nearest to the seed, ties to the earlier, and the largest squared distance
    of them; all_radius2: the largest of all; best_at_least2: what no k centres can beat. Components count as floor(scale * x), the nearest long beyond 64 bits; distances are of those.
    Null ids, null and empty vectors, those with null or non-finite components or of another length than most rows take no part. Equal vectors
    count each, but only that of least id can be a seed: there are fewer than k seeds where there are fewer different vectors.
    """
    spark, core = rows.sparkSession, core or 8 * k
    if core * 4 > block or k < 1:
        raise ValueError("a block must hold four cores, and k be 1 or more")
    given = written(_usable(rows, scale))
    start = _core(given, given.count(), block, core).collect()  # at most a block
    schema = "rank bigint, vec_id bigint, gap2 double, n_rows bigint, radius2 double, all_radius2 double, best_at_least2 double"
    if not start:
        return spark.createDataFrame([], schema)
    # of equal vectors the least id
    held: dict[tuple, int] = {}
    for r in start:
        held[tuple(r["v"])] = min(r["vec_id"], held.get(tuple(r["v"]), r["vec_id"]))
    for turn in range(rounds):
        ids, v = np.array(list(held.values())), np.array(list(held))
        taken, gaps, apart = farthest_first(ids, v, k)
        parts, far = _measured(given, v[taken], core)
        radius = max(p["most"] for p in parts)
        if radius <= apart * (1 + slack) ** 2 or turn == rounds - 1:
            break
        for r in far:
            held[tuple(r["v"])] = min(r["vec_id"], held.get(tuple(r["v"]), r["vec_id"]))
    out = [(i + 1, int(ids[t]), gaps[i] if i else 0.0, p["n"], p["most"], radius, apart / 4) for i, (t, p) in enumerate(zip(taken, parts, strict=True))]
    return spark.createDataFrame(out, schema)
