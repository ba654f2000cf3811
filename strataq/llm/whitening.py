"""Whitening of embeddings by a tiled covariance.

Vectors become whole numbers, so their sums are exact. For the covariance each row block is cut into
column blocks; every pair of column blocks is a tile, whose key takes both blocks of a row block to one
task, which multiplies them. Products are summed by place of the matrix, partly before the shuffle. The
driver assembles one matrix of dimension x dimension and takes its eigenvectors; no row passes through it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written

SCALE, SHIFT = 64, 1_000_000
_FAR = float(1 << 62)
_BEYOND = 1 << 63
MOST_MODEL_BYTES = 256 << 20


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, x: floor(64 * c) + 1000000 of each entry c as a double; null vectors and those that hold null or non-finite entries are left out.

    Entries whose scaled value is beyond 2^62 count as 2^62. Other columns don't matter, repeated ids are rows of their own, a null id stays null.
    """
    e = F.col(f"`{embedding}`")
    finite = F.coalesce(F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    whole = F.transform(e, lambda c: F.floor(F.greatest(F.least(SCALE * c.cast("double"), F.lit(_FAR)), F.lit(-_FAR))).cast("bigint") + SHIFT)
    return vectors.where(finite).select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), whole.alias("x"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, row numbers, matrix) of the vectors of each length in a batch; empty ones have none."""
    x = batch.column("x")
    sizes = np.diff(x.offsets.to_numpy())
    flat, starts = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()[:-1]
    for d in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        yield d, rows, flat[starts[rows][:, None] + np.arange(d)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S as doubles, and the sum of its squares by row as whole numbers, beyond 64 bits the greatest long.

    Arithmetic is modulo 2^64, which is exact wherever the result fits; doubles tell where it does.
    """
    mean = np.array([s / n for s in sums])
    about = n * (x - mean)
    wrapped = np.array([s % (1 << 64) for s in sums], np.uint64)
    exact = x.astype(np.uint64) * np.uint64(n % (1 << 64)) - wrapped
    signed = exact.view(np.int64)
    centred = np.where(np.abs(about) < _FAR, signed, about)
    size = np.square(about).sum(axis=1)
    total = (exact * exact).sum(axis=1, dtype=np.uint64).view(np.int64)
    far = size > _FAR
    total[far] = _BEYOND - 1
    for i in np.flatnonzero(far & (size < 4 * _FAR)):  # near the limit
        total[i] = min(_BEYOND - 1, sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums, strict=True)))
    return centred, total


def _sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and the exact sum of each dimension, by length of vectors: a row a task and dimension, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = defaultdict(int)
        high: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch):
                n[d] += len(x)  # halves of 32 bits: no sum of a batch overflows
                parts = np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]).astype(object)
                high[d] = high[d] + parts if d in high else parts
        for d, (a, b) in high.items():
            s = [Decimal(int(x) * (1 << 32) + int(y)) for x, y in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n[d]] * d, pa.int64()), pa.array(s, pa.decimal128(38, 0))], ["d", "i", "n", "s"])

    found = rows.mapInArrow(lean(run), "d int, i int, n bigint, s decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("string").alias("s")).toArrow().to_pandas()
    return {int(d): (int(g["n"].iloc[0]), [int(s) for s in g.sort_values("i")["s"]]) for d, g in found.groupby("d")}


def _products(rows: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> pd.DataFrame:
    """d, i, j, q: the sum of z_i * z_j over all rows, i <= j, z the centred rows.

    A column block is sent once for every tile that it is part of, eight times at most at any dimension; a
    task of tiles has the blocks of up to 64 row blocks, 2^20 entries each, so it is bounded, and its products are one matrix a tile.
    """
    tile = lambda d: max(32, -(-d // 8))
    names, kinds = ["part", "number", "block", "d", "ti", "tj", "place", "m", "z"], (pa.int32(),) * 8 + (pa.binary(),)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come from a written table, so a task that runs again numbers its blocks as before
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for d, _, x in _by_length(batch):
                (n, s), w, block = sums[d], tile(d), min(4096, max(64, (1 << 20) // d))
                for at in range(0, len(x), block):
                    z = deviations(x[at : at + block], n, s)[0] / n
                    cuts = [np.ascontiguousarray(z[:, c : c + w]).tobytes() for c in range(0, d, w)]
                    sent = [(part, number // 64, number, d, i, j, c, len(z), cuts[c]) for i in range(len(cuts)) for j in range(i, len(cuts)) for c in sorted({i, j})]
                    number += 1
                    for row in range(0, len(sent), 16):
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*sent[row : row + 16], strict=True), kinds, strict=True)], names)

    def multiply(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        _, _, d, ti, tj = (int(k) for k in key)
        # blocks of one tile side by side: a row block's two column blocks have one place in the order of their rows
        side = {c: np.concatenate([np.frombuffer(z, np.float64).reshape(m, -1) for m, z in zip(h["m"], h["z"], strict=True)]) for c, h in g.sort_values("block").groupby("place")}
        q = side[ti].T @ side[tj]
        i, j = (a.ravel() for a in np.indices(q.shape))
        i, j = i + ti * tile(d), j + tj * tile(d)
        kept = i <= j
        return pd.DataFrame({"d": np.int32(d), "i": i[kept].astype(np.int32), "j": j[kept].astype(np.int32), "q": q.ravel()[kept]})

    sent = rows.mapInArrow(lean(cut), "part int, number int, block int, d int, ti int, tj int, place int, m int, z binary")
    made = sent.groupBy("part", "number", "d", "ti", "tj").applyInPandas(multiply, "d int, i int, j int, q double")
    return made.groupBy("d", "i", "j").agg(F.sum("q").alias("q")).toArrow().to_pandas()


def eigen(d: int, n: int, products: pd.DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues by falling value, vectors as columns, and the trace. Values that are zero in double precision have no direction to whiten and are left out."""
    v = np.zeros((d, d))
    v[products["i"], products["j"]] = products["q"] / n
    v[products["j"], products["i"]] = products["q"] / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values[:most] > max(values[0], 0.0) * d * 2.0**-50).sum())
    return values[:kept], vectors[:, :kept], float(np.trace(v))


def whiten(vectors: DataFrame, most: int = 32, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row and its first `most` components.

    Vectors of each length are a fit of their own; empty ones have no component and give no row, nor has a
    direction without variance (all vectors of a length equal, for one). The driver holds matrices of the
    dimension alone: its square of doubles, and `most` vectors of it, which tasks read too; their size is checked.
    identity_error is measured: the covariance of the whitened rows, over all rows, less the identity.
    """
    rows = written(whole_numbers(vectors, vec_id, embedding), "whole-vectors")
    sums = _sums(rows)
    products = _products(rows, sums)
    model = {}
    for d, g in products.groupby("d"):
        values, axes, trace = eigen(int(d), sums[int(d)][0], g, most)
        if len(values):
            model[int(d)] = (*sums[int(d)], axes / np.sqrt(values), values / trace)
    if sum(a.nbytes + 40 * d for d, (_, _, a, _) in model.items()) > MOST_MODEL_BYTES:
        raise ValueError("vectors of too many lengths for one table")

    def projected(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for d, at, x in _by_length(batch):
            if d in model:
                n, s, axes, _ = model[d]
                centred, total = deviations(x, n, s)
                yield d, at, (centred / n) @ axes, total

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, w, _ in projected(batch):
                one = np.c_[np.ones(len(w)), w]
                found[d] = found.get(d, 0) + one.T @ one
        for d, q in found.items():
            i, j = (a.ravel().astype(np.int32) for a in np.indices(q.shape))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i), pa.array(j), pa.array(q.ravel())], ["d", "i", "j", "q"])

    errors = {}
    for d, g in rows.mapInArrow(lean(moments), "d int, i int, j int, q double").groupBy("d", "i", "j").agg(F.sum("q").alias("q")).toArrow().to_pandas().groupby("d"):
        n, _, axes, _ = model[int(d)]
        k = axes.shape[1] + 1
        q = np.zeros((k, k))
        q[g["i"], g["j"]] = g["q"] / n
        errors[int(d)] = float(np.abs(q[1:, 1:] - np.outer(q[0, 1:], q[0, 1:]) - np.eye(k - 1)).max())

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for d, at, w, total in projected(batch):
                n, explained = model[d][0], model[d][3]
                m, k = w.shape
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(np.repeat(total, k)), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, errors[d]))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(lean(out), "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
