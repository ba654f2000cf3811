import math
from fractions import Fraction
from random import Random

import numpy as np

from strataq.llm.common import written
from strataq.llm.topk import nra_block, read_lists, top_k, whole_components


def brute(rows, ask, k):
    """rows: (vec_id, whole numbers); of those that `ask` the k best of all others, each row its own."""
    out = []
    for n, (q, x) in enumerate(rows):
        if ask(q):
            near = lambda s: min((1 << 63) - 1, max(-(1 << 63), s))
            scored = sorted((-near(sum(a * b for a, b in zip(x, v, strict=True))), i is None, i or 0) for m, (i, v) in enumerate(rows) if m != n and len(v) == len(x))
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def run(df, ask, **blocks):
    whole = written(whole_components(df), "vectors")
    return sorted((tuple(r) for r in top_k(whole.where(ask), whole, 10, **blocks).collect()), key=repr)


def test_as_brute_force(spark):
    rng = Random(6)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(700)]
    for i in range(100, 160):
        vectors[i] = (i, vectors[100][1])
    vectors += [(i, [0.25] * 3) for i in range(700, 705)]
    vectors += [(20, [rng.uniform(-1, 1) for _ in range(8)]), (20, vectors[20][1]), (3, vectors[3][1]), (3, vectors[9][1])]  # repeated ids
    rows = [(i, v, "x") for i, v in vectors]
    vectors += [(None, [3.0 * x for x in vectors[20][1]]), (None, vectors[40][1]), (920, []), (901, [])]
    rows += [(i, v, "w") for i, v in vectors[-4:]] + [(900, None, "y"), (902, [1.0, None] * 4, "z"), (903, [math.nan] * 8, "z"), (904, [math.inf] + [0.0] * 7, "z")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, key string").repartition(3)
    want = brute([(i, [math.floor(1024 * x) for x in v]) for i, v in vectors], lambda i: i is not None and i % 20 == 0, 10)
    assert run(df, "vec_id % 20 = 0", query_block=10, row_block=150) == want
    assert run(df.limit(0), "vec_id % 20 = 0") == [] and run(df, "vec_id < 0") == []


def test_scores_beyond_64_bits(spark):
    vectors = [(0, [1e18, 2.0]), (1, [1e18, 3.5]), (2, [-1e18, 1.0]), (3, [-1e200, 1.0]), (4, [1e15, 0.0]), (5, [0.1, -0.1]), (6, [9e13, 0.5]), (7, [9e13, 0.75])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    whole = [(i, [math.floor(1024 * Fraction(x)) for x in v]) for i, v in vectors]
    assert run(df, "vec_id >= 0") == brute(whole, lambda i: True, 10)


def test_block_with_large_numbers_and_ties():
    rng = np.random.default_rng(1)
    for scale in (1, 3, 1 << 28):  # the last beyond what doubles hold
        rows = rng.integers(-3, 4, (60, 5)) * scale
        ids = np.arange(60) * 7
        want = brute([(int(i), [int(x) for x in v]) for i, v in zip(ids, rows, strict=True)], lambda i: i < 63, 4)
        found = {}
        for q, i, s in nra_block(ids, ids, rows.astype(float), ids[:9], rows[:9].astype(float), 4):
            found.setdefault(q, []).append((q, len(found.get(q, [])) + 1, i, s))
        assert sorted((x for v in found.values() for x in v), key=repr) == want


def test_lists_are_read_until_k_are_left():
    rng = np.random.default_rng(4)
    flat = rng.integers(-400, 400, (300, 32)).astype(float)  # bounds say little before the end
    skewed = np.c_[rng.permutation(300) * 1000, flat[:, :3]].astype(float)  # and much where one list decides
    for rows, least, most in ((flat, 0.625, 1.0), (skewed, 0.125, 0.125)):
        queries = np.abs(rows[:20]) + 1
        alive, stopped = read_lists(rows, queries, np.ones((20, 300), bool), 5)
        scores = rows @ queries.T
        for i in range(20):
            assert sorted(scores[alive[i], i]) == sorted(scores[:, i])[-5:]
        assert ((stopped >= least) & (stopped <= most)).mean() >= 0.8
