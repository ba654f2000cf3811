import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataq.llm.whitening import deviations, whiten

SCHEMA = "vec_id bigint, embedding array<double>"


def check(rows, vectors, most=32):
    """rows of one length as whiten gives them, against numpy: everything up to the sign of a component."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    z = ((n * x - sums) / n).astype(float)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    ids = [i for i, _ in vectors]
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, len(values) + 1))
    dev = sorted((str(i), int(((n * v - sums) ** 2).sum())) for i, v in zip(ids, x, strict=True))
    want = z @ axes / np.sqrt(values)
    for k, got in by.items():
        assert sorted((str(r.vec_id), r.deviation) for r in got) == dev and {r.n for r in got} == {n}
        assert abs(got[0].explained - values[k - 1] / np.trace(z.T @ z / n)) < 1e-9 and got[0].identity_error < 1e-8
        a, b = (sorted(zip(map(str, ids), s * want[:, k - 1], strict=True)) for s in (1, -1))
        mine = sorted((str(r.vec_id), r.whitened) for r in got)
        assert min(max(abs(p[1] - q[1]) for p, q in zip(mine, side, strict=True)) for side in (a, b)) < 1e-6


@pytest.mark.parametrize("d", [3, 70])
def test_as_numpy(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(900, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 9
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(901, None), (902, [None] + [1.0] * (d - 1)), (903, [math.nan] * d), (904, [math.inf] + [0.0] * (d - 1)), (905, [])]
    vectors += [(None, vectors[0][1]), (5, vectors[5][1]), (5, vectors[6][1])]
    df = spark.createDataFrame(vectors + odd, SCHEMA).withColumns({c: F.lit("c") for c in ("x", "d", "n", "q")}).repartition(3)
    check(whiten(df).collect(), vectors)


def test_lengths_apart_no_variance_and_empty(spark):
    rng = np.random.default_rng(1)
    two = [(i, [float(c) for c in rng.normal(size=2)]) for i in range(50)]
    four = [(i, [float(c) for c in rng.normal(size=4)]) for i in range(100, 160)]
    got = whiten(spark.createDataFrame(two + four + [(7, [1.0] * 5), (8, [1.0] * 5)], SCHEMA), most=3).collect()
    check([r for r in got if r.vec_id < 100], two)
    check([r for r in got if r.vec_id >= 100], four, 3)
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    flat = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], SCHEMA)).collect()
    assert {r.component for r in flat} == {1}  # one direction varies


def test_large_entries(spark):
    x = np.array([[1, -(1 << 62), 3], [5, 1 << 62, 7], [2, 2, 2]])
    sums = [int(s) for s in x.astype(object).sum(axis=0)]
    centred, total = deviations(x, 3, sums)
    want = 3 * x.astype(object) - np.array(sums, object)
    assert np.allclose(centred, want.astype(float), rtol=1e-15)
    assert total.tolist() == [min((1 << 63) - 1, int((r**2).sum())) for r in want]
    vectors = [(i, [float(10.0 ** (i % 7)), 1.5 * i]) for i in range(40)]
    check(whiten(spark.createDataFrame(vectors, SCHEMA)).collect(), vectors)
    far = whiten(spark.createDataFrame([(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [0.0, 5.0])], SCHEMA)).collect()
    assert far and all(math.isfinite(r.whitened) for r in far)
