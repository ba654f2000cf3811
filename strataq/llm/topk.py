"""Exact top-k by sorted access alone (no random access), over blocks of queries and rows.

In a block each dimension is a list sorted by its component. A query reads its lists from the
end that its own component's sign makes best, all to one depth, in steps. The last value read of
each list bounds what a row has in that list if it hasn't been met there, so every row met has a
lower and an upper bound, and one bound holds for all rows not met. A row is out once its upper bound
is under the k-th best lower bound. A query stops when no outsider can qualify: k rows are left. Else it
reads on, to the ends of the lists at last, where both bounds are the score. Bounds of all queries
still open and all rows not yet out of every one of them are four matrix products a step.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEPS = (0.125, 0.375, 0.625, 0.8125, 0.9375, 1.0)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _exact(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Whether doubles hold all sums of products."""
    return float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, rows.shape[1]) < 2.0**52


def read_lists(x: np.ndarray, q: np.ndarray, alive: np.ndarray, k: int, steps: tuple[float, ...] = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stay for each query, and the depth at which it stopped. The last step is 1; doubles that hold all scores."""
    n = len(x)
    alive, stopped = alive.copy(), np.ones(len(q))
    lists = np.sort(x, axis=0)  # ascending; read from either end
    low, high = lists[0], lists[-1]
    open_, rows = np.arange(len(q)), np.arange(n)
    for depth in steps:
        at = min(n - 1, int(depth * n))
        last_high, last_low, y = lists[n - 1 - at], lists[at], x[rows]
        plus, minus = np.maximum(q[open_], 0).T, np.minimum(q[open_], 0).T
        # a component not yet met lies between the list's far end and the last value read; of a row met nowhere this is the bound of all such
        upper = np.maximum(y, last_high) @ plus + np.minimum(y, last_low) @ minus if at < n - 1 else y @ q[open_].T
        lower = np.where(y >= last_high, y, low) @ plus + np.where(y <= last_low, y, high) @ minus if at < n - 1 else upper
        here = np.ix_(open_, rows)
        kth = np.partition(np.where(alive[here].T, lower, -np.inf), len(rows) - k, axis=0)[len(rows) - k]
        alive[here] &= (upper >= kth).T
        done = alive[open_].sum(axis=1) <= k
        stopped[open_[done]] = depth
        open_ = open_[~done]
        if not len(open_):
            break
        rows = np.flatnonzero(alive[open_].any(axis=0))
    return alive, stopped


def nra_block(keys: np.ndarray, ids: np.ndarray, rows: np.ndarray, query_keys: np.ndarray, queries: np.ndarray, k: int, steps: tuple[float, ...] = STEPS) -> list[tuple[int, int, int]]:
    """(query's key, row's key, score) of each query's k best rows here, ties to smaller ids. Whole numbers as doubles; keys name rows."""
    n = len(ids)
    out: list[tuple[int, int, int]] = []
    if not n or not len(query_keys):
        return out
    exact = _exact(rows, queries)
    alive = query_keys[:, None] != keys[None, :]
    if exact and n > k:
        alive, _ = read_lists(rows, queries, alive, k, steps)
    if not exact:  # beyond what doubles hold: every score as a Python int
        rows, queries = (np.frompyfunc(int, 1, 1)(x) for x in (rows, queries))
    for i, key in enumerate(query_keys.tolist()):
        left = np.flatnonzero(alive[i])
        scores = rows[left] @ queries[i]  # final scores of those that are left
        if not exact:
            scores = np.array([min(_MOST, max(_LEAST, s)) for s in scores], np.int64)
        order = np.lexsort((ids[left], -scores if exact else ~scores))[:k]
        out += [(key, int(keys[left[j]]), int(scores[j])) for j in order]
    return out


def whole_components(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024) -> DataFrame:
    """key (names the row), vec_id, v: floor(scale * x) of each component, as a double; only vectors of finite components.

    Null vectors and those that hold null or non-finite components take no part, nor those whose scaled
    components are beyond doubles; empty vectors do, and score 0 with each other. Repeated and null ids are
    rows of their own. Other columns don't matter.
    """
    x = F.col(f"`{embedding}`")
    scaled = lambda c: F.lit(float(scale)) * c.cast("double")
    finite = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(scaled(c)) < float("inf"))), F.lit(False))
    whole = F.transform(x, lambda c: F.when(F.abs(scaled(c)) < float(1 << 53), F.floor(scaled(c)).cast("double")).otherwise(scaled(c)))
    return vectors.where(finite).select(F.monotonically_increasing_id().alias("key"), F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), whole.alias("v"))


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, query_block: int = 1024, row_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows by inner product, the query's own row left out.

    Both sides: key, vec_id, v, as `whole_components` has them, written before (a key must not
    change). Other rows of the query's id are candidates; each row of a repeated id asks for itself. Rows
    without an id are candidates too, and come last among equal scores.
    Scores beyond 64 bits count as the nearest long. Queries and rows are hashed to blocks of
    bounded size, every query block meets every row block in a task of its own, and the k best
    of each block meet in a ranking of k rows a block. So rows are sent once a query block: the
    price of an exact answer. Vectors meet only those of their length. No query or no row: nothing.
    """
    n_rows, n_queries = rows.count(), queries.count()
    rb, qb = max(1, -(-n_rows // row_block)), max(1, -(-n_queries // query_block))
    block_of = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("key", "vec_id", "v", F.size("v").alias("dim"), block_of(qb).alias("qb"), every(rb).alias("rb"))
    # both sides may come from one table: new names keep the cogroup from taking its columns for the same
    no_id = F.col("vec_id").isNull().cast("bigint")  # such a row has the greatest id in a block
    right = rows.select(F.col("key").alias("row_key"), F.coalesce("vec_id", F.lit(_MOST)).alias("row_vec_id"), F.col("v").alias("row_v"), no_id.alias("no_id"), F.size("v").alias("dim"), block_of(rb).alias("rb"), every(qb).alias("qb"))
    columns = ["query_key", "query_id", "vec_id", "no_id", "score"]

    def block(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({c: [] for c in columns}).astype("int64")
        keys = r["row_key"].to_numpy()
        found = nra_block(keys, r["row_vec_id"].to_numpy(), np.stack(r["row_v"].to_list()), q["key"].to_numpy(), np.stack(q["v"].to_list()), k)
        ids, row_ids = dict(zip(q["key"].tolist(), q["vec_id"].tolist(), strict=True)), dict(zip(keys.tolist(), zip(r["row_vec_id"].tolist(), r["no_id"].tolist(), strict=True), strict=True))
        return pd.DataFrame([(key, ids[key], *row_ids[row], score) for key, row, score in found], columns=columns).astype("int64")

    block_keys = ["qb", "rb", "dim"]
    best = left.groupBy(*block_keys).cogroup(right.groupBy(*block_keys)).applyInPandas(block, ", ".join(f"{c} bigint" for c in columns))
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.col("score").desc(), "no_id", "vec_id"))
    return best.select("query_id", rank.alias("rank"), F.when(F.col("no_id") == 0, F.col("vec_id")).alias("vec_id"), "score").where(F.col("rank") <= k)
