"""Two-way merge and reconciliation by ranges."""

from random import Random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataq.operators import merge, reconcile, sync

FIELDS = ("a", "b")
SIDE = st.dictionaries(st.integers(0, 5), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2])), max_size=6)


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], "k int, a string, b int").withColumns({c: F.lit(0) for c in ("l", "r", "key")})


def brute(local, remote, base, prefer):
    out, found = {}, set()
    for k in {*local, *remote}:
        one, two, was = local.get(k), remote.get(k), base.get(k)
        if one is None or two is None:
            kept = two if one is None else one
            if was is not None and kept != was:
                found.add((k, "*"))
            if was is None or kept != was:
                out[k] = kept
            continue
        new = []
        for i, f in enumerate(FIELDS):
            changed = [was is None or x[i] != was[i] for x in (one, two)]
            if all(changed) and one[i] != two[i]:
                found.add((k, f))
                new.append((one if prefer == "local" else two)[i])
            else:
                new.append(one[i] if changed[0] else two[i])
        out[k] = tuple(new)
    return out, found


@settings(max_examples=12, deadline=None)
@given(SIDE, SIDE, SIDE, st.sampled_from(["local", "remote"]))
def test_merge_as_brute_force_and_twice(spark, local, remote, base, prefer):
    sides = [frame(spark, x) for x in (local, remote, base)]
    rows = lambda df: {r.k: (r.a, r.b) for r in df.collect()}
    got = rows(merge.merged(*sides, "k", FIELDS, prefer))
    want, apart = brute(local, remote, base, prefer)
    assert got == want and {(r.k, r.field) for r in merge.conflicts(*sides, "k", FIELDS).collect()} == apart
    new = frame(spark, got)
    assert rows(merge.merged(new, sides[1], sides[2], "k", FIELDS, prefer)) == got and rows(merge.merged(sides[0], new, sides[2], "k", FIELDS, prefer)) == got
    assert merge.conflicts(new, new, sides[2], "k", FIELDS).where("field <> '*'").count() == 0


def test_conflict_values(spark):
    local, remote, base = ({1: ("x", 2), 2: ("y", 1)}, {1: ("y", 3)}, {1: ("x", 1), 2: ("x", 1)})
    got = {(r.k, r.field): tuple(r)[2:] for r in merge.conflicts(*(frame(spark, x) for x in (local, remote, base)), "k", FIELDS).collect()}
    assert got[(1, "b")] == ("1", "2", "3") and got[(2, "*")][2] is None and len(got) == 2
    with pytest.raises(ValueError):
        merge.merged(*(frame(spark, {}),) * 3, "k", FIELDS, "both")


@pytest.mark.parametrize(("n", "edits", "depth"), [(0, 0, None), (1, 1, 2), (30_000, 0, 3), (30_000, 12, 3), (3000, 2600, 3)])
def test_reconciled_as_changes(spark, tmp_path, monkeypatch, n, edits, depth):
    monkeypatch.setattr(reconcile, "MOST_NODES", 200)
    rng = Random(n + edits)
    one = {i: f"text {i}" for i in range(n)}
    other = dict(one)
    for i in rng.sample(range(n), min(n, edits)):
        kind = rng.randrange(3)
        if kind == 0:
            other[i] = None if i % 2 else "edited"
        elif kind == 1:
            del other[i]
        else:
            other[n + i] = "new"
    sides = []
    for name, rows in (("one", one), ("other", other)):
        df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
        reconcile.keep(df, f"{tmp_path}/{name}", depth=depth)
        sides.append(df)
    got = reconcile.reconciled(spark, f"{tmp_path}/one", f"{tmp_path}/other")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sync.changes(*sides).select("doc_id", "op", "content_hash").collect()))
    level, nodes, counts = reconcile.differing(spark, f"{tmp_path}/one", f"{tmp_path}/other")
    if edits == 12:  # a few nodes of each level, and of the rows those of a few of 4,096 ranges
        assert level == 3 and len(nodes) <= 12 and sum(counts) <= 1 + 16 + 12 * 16 * 2
        inside = reconcile._in_ranges("place", reconcile._ranges(nodes, 1 << (reconcile.BITS - 12)))
        assert spark.read.parquet(f"{tmp_path}/one/rows").where(inside).count() <= 12 * 40
    if n and not edits:
        assert nodes == [] and counts == [1]


def test_ranges_hold_all_nodes():
    rng = Random(1)
    for most in (1, 3, 64):
        nodes = sorted(rng.sample(range(1000), 50))
        got = reconcile._ranges(nodes, 10, most)
        assert len(got) <= most and all(any(a <= n * 10 and n * 10 + 9 <= b for a, b in got) for n in nodes) and got == sorted(got)
    assert reconcile._ranges([], 10) == []
