from random import Random

import numpy as np

from strataq.llm.components import components
from strataq.llm import neardup
from strataq.llm.neardup import COORDINATES, near_duplicates, odd_sketches, prefix_pairs, shingle_sets, sketches


def shingles(text, k):
    import re

    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i, _ in rows}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                comp[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def run(spark, rows, k, schema="doc_id bigint, text string"):
    return sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, schema).repartition(3), k).collect()), key=str)


def test_as_brute_force(spark):
    rng = Random(5)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 3)))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [None, "", "  \n", "One two", "one\ttwo", "one two three", texts[0].upper(), texts[0], "a " * 500]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert sorted(run(spark, rows, 4)) == brute(rows, 4)


def test_frequent_but_unlike(spark):
    """Many documents that share most of their text but are not alike."""
    rng = Random(6)
    shared = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(shared + [f"x{rng.randrange(10**9)}" for _ in range(12)])) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " tail") for i in range(5)]
    assert sorted(run(spark, rows, 4)) == brute(rows, 4)


def template_sets(rng, n, size, kept, parents=0):
    """Random parts of one set, each element kept with this chance and the rest its own; `parents` of them have a near copy."""
    template = rng.integers(0, 2**63, size, np.uint64)
    sets = []
    for _ in range(n):
        mine = template[rng.random(size) < kept]
        sets.append(np.unique(np.concatenate([mine, rng.integers(0, 2**63, size - len(mine), np.uint64)])))
    for x in sets[:parents]:
        sets.append(np.unique(np.concatenate([x[len(x) // 20 :], rng.integers(0, 2**63, 3, np.uint64)])))
    return sets


def alike(sets):
    pairs = ((i, j) for i in range(len(sets)) for j in range(i))
    both = lambda a, b: len(np.intersect1d(a, b, assume_unique=True))
    return {(j, i) for i, j in pairs if 180 * both(sets[i], sets[j]) >= 80 * (len(sets[i]) + len(sets[j]))}


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_FEW", 4)
    monkeypatch.setattr(neardup, "_BLOCK", 30)
    monkeypatch.setattr(neardup, "_SAMPLED", 100)
    rng = np.random.default_rng(2)
    sets = template_sets(rng, 120, 90, 0.9, 20) + template_sets(rng, 60, 400, 0.92, 20)
    comp = [i if i % 5 else 1000 for i in range(len(sets))]
    rows = [(i, comp[i], bytearray(x.tobytes())) for i, x in enumerate(sets)]
    found = prefix_pairs(spark.createDataFrame(rows, "doc_id bigint, comp bigint, items binary").repartition(3), 80).collect()
    found = {tuple(sorted(r)) for r in found}
    wanted = {(i, j) for i, j in alike(sets) if comp[i] != comp[j]}
    assert wanted and wanted <= found and all(comp[i] != comp[j] for i, j in found)


def test_candidates_of_one_template_grow_with_its_documents(spark):
    """Sets that are 0.66 alike in pairs, and near copies of some: few candidates but the copies."""
    rng = np.random.default_rng(3)
    sets = template_sets(rng, 2000, 120, 0.81, 100)
    rows = [(i, i, bytearray(x.tobytes())) for i, x in enumerate(sets)]
    found = {tuple(sorted(r)) for r in prefix_pairs(spark.createDataFrame(rows, "doc_id bigint, comp bigint, items binary").repartition(4), 80).collect()}
    assert {(i, 2000 + i) for i in range(100)} <= found and len(found) < 4000


def test_odd_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 900, np.uint64)
    sets = [a, a[50:], np.concatenate([a[:800], rng.integers(0, 2**63, 200, np.uint64)]), a[:0]]
    x = odd_sketches(sets, np.zeros(4, np.int64))
    apart = lambda i, j: int(np.bitwise_count(x[i] ^ x[j]).sum())
    assert [apart(0, 0), apart(0, 1) <= 50, apart(0, 2) <= 300, apart(0, 2) > 240, apart(3, 3)] == [0, True, True, True, 0]


def test_odd_rows(spark):
    rows = [(None, "a b c d e", 1, "p"), (3, "a b c d e", 2, "q"), (3, "a b c d e", 2, None), (4, None, None, None)]
    assert run(spark, rows, 4, "doc_id bigint, text string, n int, digest string") == [(3, 2, 3, True), (3, 2, 3, True), (4, 0, 4, True), (None, 2, None, True)]
    assert run(spark, [], 4) == []


def test_links_of_nameless_rows_and_of_all_texts_of_an_id(spark):
    rng = Random(9)
    base = [[f"{x}{rng.randrange(10**6)}" for _ in range(100)] for x in "abc"]
    near = lambda w, *at: " ".join(["new" if i in at else x for i, x in enumerate(w)])
    a, b, c = base
    rows = [(20, near(a, 3, 20)), (None, near(a, 50, 3)), (21, near(a, 50, 80))]  # 20 - none - 21: the ends alone aren't alike
    rows += [(1, near(b)), (5, near(b, 50)), (1, near(c)), (6, near(c, 50))]  # id 1 is the least of two classes' links
    assert [x[2] for x in run(spark, [rows[0], rows[2]], 4)] == [20, 21]
    want = {(None, None), (20, 20), (21, 20), (1, 1), (5, 1), (6, 1)}
    for _ in range(2):
        assert {(i, comp) for i, _, comp, _ in run(spark, rows, 4)} == want
        rng.shuffle(rows)


def test_sketch_is_filled_and_fair():
    rng = Random(7)
    a, b = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (1, 900)]
    words = b.split()
    c = " ".join(words[:700] + ["z"] + words[701:])
    owner, hashes = shingle_sets([a, b, c], 4)
    got = sketches(owner, hashes, 3)
    assert (got != np.iinfo(np.uint64).max).all()
    assert (got[1] == got[2]).mean() > 0.95 and (got[0] == got[1]).mean() < 0.05 and got.shape == (3, COORDINATES)


def test_a_very_long_text_in_parts(monkeypatch):
    rng = Random(8)
    texts = [" ".join(f"é{rng.randrange(50)}\x1c" for _ in range(n)) for n in (3000, 2, 700)] + [None]
    want = shingle_sets(texts, 4)
    monkeypatch.setattr(neardup, "_CHUNK", 400)
    assert len(neardup._parts(texts[0], 4)) > 10
    assert all((a == b).all() for a, b in zip(neardup._sets(texts, 4), want, strict=True))


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7)] + [(1000, x) for x in range(1001, 1100)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {i: 0 for i in range(1, 51)} | {150: 100, 200: 100} | {x: 1000 for x in range(1001, 1100)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_of_each_with_any_column_names(spark):
    rows = [(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (3, None, "z", 3), (3, None, "z", 3), (None, "a b c d e f", "w", 4), (4, "", "v", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _h string, id int")
    got = neardup.one_of_each(df)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[5]], key=str)
    assert neardup.one_of_each(df.limit(0)).count() == 0
