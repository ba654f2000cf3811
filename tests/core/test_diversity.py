from itertools import combinations

import numpy as np
import pytest

from strataq.operators.diversity import diverse, farthest_first

SCHEMA = "vec_id bigint, embedding array<float>, v string"


def squared(a, b):
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def frame(spark, v, extra=()):
    return spark.createDataFrame([(i, [float(x) for x in row], "x") for i, row in enumerate(v)] + list(extra), SCHEMA)


def test_within_twice_the_best_of_all_choices(spark):
    rng = np.random.default_rng(3)
    for _ in range(2):
        v = rng.integers(-20, 20, (16, 2))
        got = diverse(frame(spark, v), 3, 1).collect()
        d = squared(v, v)
        best = min(d[:, list(c)].min(axis=1).max() for c in combinations(range(16), 3))
        radius = d[:, [r["vec_id"] for r in got]].min(axis=1).max()
        assert {r["all_radius2"] for r in got} == {radius} and radius <= 4 * best
        assert all(r["best_at_least2"] <= best for r in got)


@pytest.mark.parametrize("k", [1, 5])
def test_many_blocks_are_measured_and_proved(spark, k):
    rng = np.random.default_rng(4)
    v = np.concatenate([np.tile(rng.integers(0, 9, (1, 3)), (400, 1)), rng.integers(-300, 300, (1500, 3)), [[5000, 0, 0], [0, 5000, 0]]])
    got = diverse(frame(spark, v), k, 1, 64, 2 * k if k > 1 else 4).orderBy("rank").collect()
    seeds = v[[r["vec_id"] for r in got]]
    d = squared(v, seeds)
    near = d.argmin(axis=1)
    assert [r["rank"] for r in got] == list(range(1, k + 1)) and got[0]["vec_id"] == 0
    assert [r["n_rows"] for r in got] == np.bincount(near, minlength=k).tolist()
    assert [r["radius2"] for r in got] == [d[near == i, i].max() for i in range(k)]
    assert got[0]["all_radius2"] == d.min(axis=1).max() <= 4 * got[0]["best_at_least2"]
    assert all(r["gap2"] == squared(seeds[i : i + 1], seeds[:i]).min() for i, r in enumerate(got) if i)


def test_odd_rows(spark):
    odd = [(None, [1.0, 1.0], "a"), (50, None, "b"), (51, [], "c"), (52, [1.0, None], "d"), (53, [float("nan"), 0.0], "e"), (54, [float("inf"), 0.0], "f"), (55, [1.0], "g")]
    v = [[0, 0], [3, 4], [0, 0], [3, 4]]
    got = diverse(frame(spark, v, odd), 3, 1).orderBy("rank").collect()
    assert [(r["vec_id"], r["gap2"], r["n_rows"], r["radius2"], r["best_at_least2"]) for r in got] == [(0, 0.0, 2, 0.0, 0.0), (1, 25.0, 2, 0.0, 0.0)]
    assert diverse(frame(spark, [], odd[1:5]), 2).count() == 0
    assert diverse(frame(spark, []), 2).count() == 0
    with pytest.raises(ValueError):
        diverse(frame(spark, v), 2, 1, 8, 4)


def test_ties_go_to_smaller_ids():
    ids, v = np.array([7, 3, 5, 4]), np.array([[0.0], [1.0], [2.0], [0.0]])
    taken, gaps, apart = farthest_first(ids, v, 2)
    assert [ids[t] for t in taken] == [3, 4] and gaps[1] == 1 and apart == 1
