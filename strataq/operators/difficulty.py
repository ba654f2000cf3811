"""Difficulty evaluation: features, bands, quantiles, a scored request, likeness to a group's centre."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def text_features(docs: DataFrame) -> DataFrame:
    n = F.size(F.split("text", " ")).cast("bigint")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("chars"), n.alias("words"), F.round(F.ln(n), 6).alias("log_words"))


def relative_bands(turns: DataFrame, bands: int = 5) -> DataFrame:
    """Band (ntile) and percent rank of each turn by length within its role; a null role is one of its own, a null text shorter than any.

    Windows span a role's table of lengths, one length's table of ranges of conversations, or the turns of one length in one range.
    """
    role = F.coalesce(F.concat(F.lit("="), F.col("role")), F.lit(""))
    given = turns.select("conv_id", "turn", role.alias("role"), F.coalesce(F.length("text"), F.lit(-1)).alias("size"), F.coalesce(F.floor(F.col("conv_id") / 4096), F.lit(-(1 << 62))).alias("range"))
    # a row's place is that of its length, by prefix sums over counts, and its place among equal lengths
    counts = given.groupBy("role", "size").agg(F.count(F.lit(1)).alias("n"))
    role = Window.partitionBy("role")
    starts = counts.select("role", "size", (F.sum("n").over(role.orderBy("size")) - F.col("n")).alias("start"), F.sum("n").over(role).alias("all"))
    pieces = given.groupBy("role", "size", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("role", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("role", "size", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    at = F.col("start") + F.col("before") + F.row_number().over(Window.partitionBy("role", "size", "range").orderBy("conv_id", "turn")) - 1
    placed = given.join(pieces, ["role", "size", "range"]).join(starts, ["role", "size"]).withColumn("at", at)
    least, more = F.floor(F.col("all") / bands), F.col("all") % bands  # the first bands have one row more
    wide = more * (least + 1)
    band = F.when(F.col("at") < wide, F.floor(F.col("at") / (least + 1))).otherwise(more + F.floor((F.col("at") - wide) / F.greatest(least, F.lit(1))))
    share = F.when(F.col("all") > 1, F.col("at") / (F.col("all") - 1)).otherwise(0.0)
    return placed.select("conv_id", "turn", (band + 1).cast("bigint").alias("band"), F.round(share, 6).alias("rank"))


def length_bands(pairs: DataFrame, short: int = 500, medium: int = 1000) -> DataFrame:
    n = F.length("answer")
    return pairs.select("conv_id", "turn", n.cast("bigint").alias("answer_chars"), F.when(n < short, "short").when(n < medium, "medium").otherwise("long").alias("band"))


def quantiles(docs: DataFrame, exact: bool = True) -> DataFrame:
    """Median and ninth decile by language; exact ones hold a count per value, the others a bounded sketch."""
    q = (lambda p: F.percentile("n_chars", F.lit(p))) if exact else (lambda p: F.percentile_approx("n_chars", p).cast("double"))
    return docs.groupBy("lang").agg(q(0.5).alias("median"), q(0.9).alias("decile9"))


def centre_likeness(embeddings: DataFrame) -> DataFrame:
    """Cosine of each vector with the mean of its label: means are partial sums, labels join by key."""
    spread = embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = spread.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centre = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    v, c = F.col("embedding"), F.col("c")
    return embeddings.join(centre, "label").select("vec_id", F.round(dot(v, c) / F.sqrt(dot(v, v) * dot(c, c)), 5).alias("likeness"))


def neighbours(queries: DataFrame, rows: DataFrame, k: int = 5, block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, likeness: the k rows of largest cosine (5 decimals) to each query, ties to smaller ids.

    Queries and rows (vec_id, embedding) are hashed to blocks of bounded size; each block of queries
    meets each of rows in a task of its own, and k rows a block meet in the ranking. A vector is
    compared with those of its length, but not with rows of its own id; null and zero vectors and those with
    null or non-finite components take no part. Vectors are scaled by their largest component, so none is too small or large.
    """
    n = lambda df: max(1, -(-df.count() // block))
    qb, rb = n(queries), n(rows)
    usable = lambda df: df.where("vec_id is not null and size(embedding) > 0 and exists(embedding, x -> x <> 0) and coalesce(forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')), false)")
    home = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = usable(queries).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"), F.size("embedding").alias("dim"), home(qb).alias("qb"), every(rb).alias("rb"))
    right = usable(rows).select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("v"), F.size("embedding").alias("dim"), home(rb).alias("rb"), every(qb).alias("qb"))

    def unit(v: np.ndarray) -> np.ndarray:
        v = v / np.abs(v).max(axis=1, keepdims=True)
        return v / np.sqrt((v * v).sum(axis=1, keepdims=True))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            x, y = (unit(np.stack(list(c)).astype(np.float64)) for c in (a["q"], b["v"]))
            ids = b["row_id"].to_numpy()
            for i, query in enumerate(a["query_id"].tolist()):
                others = np.flatnonzero(ids != query)
                likeness = np.round(y[others] @ x[i], 5)
                if len(others) > k:  # all that tie with the last stay
                    near = likeness >= np.partition(likeness, -k)[-k]
                    others, likeness = others[near], likeness[near]
                out += [(query, int(ids[others[j]]), float(likeness[j])) for j in np.lexsort((ids[others], -likeness))[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "likeness"]).astype({"query_id": "int64", "vec_id": "int64", "likeness": "float64"})

    keys = ["qb", "rb", "dim"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, "query_id bigint, vec_id bigint, likeness double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("likeness").desc(), "vec_id"))
    return near.select("query_id", rank.cast("bigint").alias("rank"), "vec_id", "likeness").where(F.col("rank") <= k)
