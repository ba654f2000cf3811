"""Joins by time against brute force, with nulls, ties, repeats, hot keys and clashing names."""

from random import Random

import pytest
from pyspark.sql import functions as F

from strataq.operators import temporal

LEFT = "id bigint, key string, at bigint, row string, value int, bucket int, held int, kind int"
RIGHT = "key string, at bigint, v int, w string"


def sides(seed, n, keys, span):
    draw = Random(seed)
    key = lambda: None if draw.random() < 0.05 else draw.choice(keys)
    at = lambda: None if draw.random() < 0.05 else draw.randrange(-span, span)
    left = [(i // 2, key(), at(), "r", 1, 2, 3, 4) for i in range(n)]
    right = [(key(), at(), draw.choice([None, 1, 2]), draw.choice([None, "x"])) for _ in range(n // 3)]
    return left, right


def last(row, right, within):
    found = [r for r in right if r[0] == row[1] and None not in (row[1], row[2], r[1]) and r[1] <= row[2] and (within is None or row[2] - r[1] <= within)]
    best = max(found, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3] is not None, r[3] or ""), default=None)
    return best and (best[2], best[3], best[1])


@pytest.mark.parametrize("seed,keys,span,bucket,within", [(1, "abc", 40, 7, None), (2, "a", 200, 1000, 9), (3, "ab", 5, 1, None), (4, "aaaab", 1000, 50, 30)])
def test_as_of_as_brute_force(spark, seed, keys, span, bucket, within):
    left, right = sides(seed, 240, keys, span)
    got = temporal.as_of(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "key", "at", ["v", "w"], "found", bucket, within)
    rows = sorted((repr(tuple(r)[:8]), repr(r.found and tuple(r.found))) for r in got.collect())
    assert rows == sorted((repr(r), repr(last(r, right, within))) for r in left)


def test_as_of_empty_and_clash(spark):
    left, right = sides(5, 20, "a", 5)
    one, none = spark.createDataFrame(left, LEFT), spark.createDataFrame([], RIGHT)
    got = temporal.as_of(one, none, "key", "at", ["v"]).collect()
    assert len(got) == 20 and all(r["last"] is None for r in got)
    assert not temporal.as_of(one.limit(0), spark.createDataFrame(right, RIGHT), "key", "at", ["v"]).collect()
    with pytest.raises(ValueError):
        temporal.as_of(one, none, "key", "at", ["v"], into="row")


def test_as_of_sorts_a_hot_key_in_many_groups(spark):
    left = spark.range(20000).select("id", F.lit("hot").alias("key"), F.col("id").alias("at"))
    right = spark.range(0, 20000, 7).select(F.lit("hot").alias("key"), F.col("id").alias("at"), F.col("id").alias("v"))
    got = temporal.as_of(left, right, "key", "at", ["v"], bucket=100)
    assert got.where("last.v = id - id % 7").count() == 20000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 2 and sum("bucket#" in x.split("], [")[1] for x in windows) == 1  # one within (key, bucket), one over a key's buckets


INTERVAL = "id bigint, k string, a bigint, b bigint, row int, bin int, level int, width int"


def intervals(seed, n, longest):
    draw = Random(seed)
    out = []
    for i in range(n):
        a = draw.randrange(-500, 500)
        b = a + draw.choice([0, 0, 1, draw.randrange(30), draw.randrange(longest)])
        out.append((i - i % 2, draw.choice(["x", "x", "y", None]), None if draw.random() < 0.04 else a, draw.choice([b] * 20 + [None, a - 1]), 1, 2, 3, 4))
    return out


@pytest.mark.parametrize("seed,longest,finest", [(1, 900, 4), (2, 60, 1), (3, 900, 10_000), (4, 5, 3)])
@pytest.mark.parametrize("key", [None, "k"])
def test_meeting_as_brute_force(spark, seed, longest, finest, key):
    left, right = intervals(seed, 90, longest), intervals(seed + 50, 70, longest)
    fits = lambda r: None not in r[2:4] and r[2] <= r[3]
    want = [(x, y) for x in left for y in right if fits(x) and fits(y) and x[2] <= y[3] and y[2] <= x[3] and (not key or (x[1] is not None and x[1] == y[1]))]
    got = temporal.meeting(spark.createDataFrame(left, INTERVAL), spark.createDataFrame(right, INTERVAL), "a", "b", key, finest)
    assert want and sorted(map(repr, want)) == sorted(repr((tuple(r.one), tuple(r.other))) for r in got.collect())


def test_meeting_has_no_nested_loop_and_takes_what_is_odd(spark):
    big = spark.createDataFrame([(1, -(2**63), 2**63 - 1), (2, 2**63 - 1, 2**63 - 1), (3, 5, 5)], "id bigint, a bigint, b bigint")
    got = temporal.meeting(big, big.limit(0), "a", "b")
    assert not got.collect()
    plan = temporal.meeting(big, big, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
