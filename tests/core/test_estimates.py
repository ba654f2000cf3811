import numpy as np

from strataq.operators.estimates import SMOOTH, agreement, solve_difficulty


def dawid_skene(votes, n, reviewers, k, rounds):
    """votes: (item, reviewer, class) as numbers."""
    p = np.zeros((n, k))
    for i, _, v in votes:
        p[i, v] += 1
    p /= p.sum(1, keepdims=True)
    for r in range(rounds + 1):
        share = np.full((reviewers, k, k), SMOOTH)
        for i, j, v in votes:
            share[j, :, v] += p[i]
        share /= share.sum(2, keepdims=True)
        if r == rounds:
            return p, share
        log = np.tile(np.log((p.sum(0) + SMOOTH) / (n + SMOOTH * k)), (n, 1))
        for i, j, v in votes:
            log[i] += np.log(share[j, :, v])
        w = np.exp(log - log.max(1, keepdims=True))
        p = w / w.sum(1, keepdims=True)


def test_agreement_as_numpy_on_planted_reviewers(spark):
    rng = np.random.default_rng(5)
    n, names = 300, "abc"
    truth = rng.integers(0, 3, n)
    right = [0.95, 0.9, 0.85, 0.6, 0.34]
    votes = [(i, j, int(truth[i]) if rng.random() < right[j] else int(rng.integers(0, 3))) for i in range(n) for j in range(5) if rng.random() < 0.9]
    rows = [(i, f"r{j}", names[v]) for i, j, v in votes]
    df = spark.createDataFrame([*rows, (None, "r0", "a"), (1, None, "a"), (1, "r0", None), (1, "r0", "zz")], "item int, reviewer string, vote string")
    for rounds in (0, 4):
        p, share = agreement(df, list(names), rounds, 0.0)
        want, shares = dawid_skene(votes, n, 5, 3, rounds)
        got = {(r["item"], names.index(r["class"])): r["p"] for r in p.collect()}
        seen = {i for i, _, _ in votes}
        assert len(got) == 3 * len(seen) and max(abs(got[i, c] - want[i, c]) for i in seen for c in range(3)) < 1e-9
        assert all(abs(r["share"] - shares[int(r["reviewer"][1]), names.index(r["class"]), names.index(r["vote"])]) < 1e-9 for r in share.collect())
    best = {}
    for (i, c), x in got.items():
        best[i] = max(best.get(i, (0, 0)), (x, c))
    assert np.mean([best[i][1] == truth[i] for i in best]) > 0.93
    assert agreement(df.limit(0), list(names))[0].count() == 0


def test_difficulty_of_planted_parameters(spark):
    rng = np.random.default_rng(6)
    ability, difficulty = rng.normal(0, 1, 150), rng.normal(0, 1.2, 40)
    rows = [(f"s{u}", i, bool(rng.random() < 1 / (1 + np.exp(difficulty[i] - ability[u])))) for u in range(150) for i in range(40)]
    rows += [("s0", 40, True), ("s1", 40, True), (None, 1, True), ("s1", None, True), ("s1", 1, None)]
    items, solvers = solve_difficulty(spark.createDataFrame(rows, "solver string, item int, solved boolean"), 6, 1e-3)
    got = {r["item"]: r for r in items.collect()}
    assert got[40]["n"] == 2 and np.isfinite(got[40]["difficulty"])
    assert np.corrcoef([got[i]["difficulty"] for i in range(40)], difficulty)[0, 1] > 0.97
    able = {r["solver"]: r["ability"] for r in solvers.collect()}
    assert np.corrcoef([able[f"s{u}"] for u in range(150)], ability)[0, 1] > 0.85
