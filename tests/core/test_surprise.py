import re
from collections import Counter, defaultdict
from hashlib import sha256
from math import log2

import pytest

from strataq.operators import surprise as module
from strataq.operators.surprise import START, chances, counted, looked_up, surprise


def found_runs(text, order):
    words = [START] * (order - 1) + [w if len(w) <= 64 else sha256(w.encode()).hexdigest() for w in re.findall(r"[^ \t\n\r]+", (text or "").lower())]
    return [tuple(words[i - order + 1 : i + 1]) for i in range(order - 1, len(words))]


def brute(corpus, order):
    """The chance of a run's last word, by the textbook's recursion over counts in memory."""
    counts = {order: Counter(r for t in corpus for r in found_runs(t, order))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(r[1:] for r in counts[k + 1])
    totals, kinds, discount = defaultdict(Counter), defaultdict(Counter), {}
    for k, c in counts.items():
        once, twice = (sum(v == x for v in c.values()) for x in (1, 2))
        discount[k] = once / (once + 2 * twice) if once else 0.5
        for r, v in c.items():
            totals[k][r[:-1]] += v
            kinds[k][r[:-1]] += 1

    def chance(run):
        k = len(run)
        less = chance(run[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        total = totals[k][run[:-1]]
        return (max(counts[k][run] - discount[k], 0) + discount[k] * kinds[k][run[:-1]] * less) / total if total else less

    return chance, counts


CORPUS = ["the cat sat on the mat", "The cat ate", "the dog sat  on\nthe cat", "a dog ate the mat on the mat", None, "", " \n", "the the the the", "x" * 300 + " sat", "the cat sat on the mat"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_bits_as_brute_force(spark, order):
    model = counted(spark.createDataFrame([(t, 1) for t in CORPUS], "body string, n int"), "body", order)
    texts = [*CORPUS, "the cat sat", "unseen words the cat", "mat on " + "x" * 300, "THE", "ß é the"]
    df = spark.createDataFrame([(i, i % 3, t, 0.5, 7) for i, t in enumerate(texts)], "p int, n int, w0 string, c double, total int")
    chance, _ = brute(CORPUS, order)
    got = {r["p"]: r for r in surprise(df, ["p", "n"], "w0", model).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        found = found_runs(t, order)
        assert got[i]["words"] == len(found)
        assert got[i]["bits"] == pytest.approx(sum(-log2(chance(r)) for r in found) / len(found) if found else 0.0, abs=1e-9)


@pytest.mark.parametrize(("ranked", "hot", "order"), [(1, 1, 3), (4, 3, 3), (8, 1000, 3), (4, 3, 4), (4, 3, 2), (1 << 20, 1 << 20, 3)])
def test_words_with_and_without_rank_and_hot_ones(spark, monkeypatch, ranked, hot, order):
    monkeypatch.setattr(module, "RANKED", ranked)
    monkeypatch.setattr(module, "HOT_WORDS", hot)
    model = counted(spark.createDataFrame([(t,) for t in CORPUS], "body string"), "body", order)
    chance, _ = brute(CORPUS, order)
    asked = sorted({r for t in [*CORPUS, "the cat sat", "unseen words the cat", "mat mat on the"] for r in found_runs(t, order)})
    got = chances(spark.createDataFrame(asked, ", ".join(f"w{i} string" for i in range(order))), model).collect()
    assert {tuple(r)[:order]: pytest.approx(r["p"], abs=1e-12) for r in got} == {r: chance(r) for r in asked}
    assert len(got) == len(asked)


def test_only_what_is_asked_is_written(spark, monkeypatch):
    """tables of all runs and of all that they begin with grew with the corpus, five times over."""
    rows = []
    real = module.written
    monkeypatch.setattr(module, "written", lambda df: rows.append((out := real(df)).count()) or out)
    corpus = spark.range(200).selectExpr("concat_ws(' ', transform(sequence(0, 99), i -> 'w' || (i * (id + 7) * 31 % 101 + i % 3))) AS t")
    model = counted(corpus, "t")
    found = surprise(spark.createDataFrame([(1, "w3 w4 w5"), (2, "w7")], "id int, q string"), ["id"], "q", model)
    assert sorted((r["id"], r["words"]) for r in found.collect()) == [(1, 3), (2, 1)]
    assert max(rows) < 200, rows  # some hundred words, few asked runs; there are 20,000 runs


def test_chances_after_a_start_sum_to_one(spark):
    model = counted(spark.createDataFrame([(t,) for t in CORPUS], "body string"), "body", 3)
    _, counts = brute(CORPUS, 3)
    words = [*(r[0] for r in counts[1]), "no such word"]
    for start in (("the", "cat"), ("on", "the"), (START, START), ("cat", "on"), ("nobody", "knows")):
        asked = spark.createDataFrame([(*start, w) for w in words], "w0 string, w1 string, w2 string")
        assert sum(r["p"] for r in chances(asked, model).collect()) == pytest.approx(1, abs=1e-9)


def test_empty_corpus_and_no_texts(spark):
    model = counted(spark.createDataFrame([], "body string"), "body")
    texts = spark.createDataFrame([(1, "some words"), (2, None)], "id int, t string")
    assert sorted(map(tuple, surprise(texts, ["id"], "t", model).collect())) == [(1, 2, 0.0), (2, 0, 0.0)]
    assert surprise(texts.limit(0), ["id"], "t", model).count() == 0


def test_common_keys_stay_where_they_are(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(900)] + [(f"k{i}", i) for i in range(50)] + [("none", 1)] * 3, "k string, i int")
    table = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(40)], ("unused", 5)], "k string, v int")
    want = sorted(rows.join(table, ["k"], "left").select("k", "i", "v").collect(), key=repr)
    for hot in (2, 10, 10_000):
        assert sorted(looked_up(rows, table, ["k"], hot).select("k", "i", "v").collect(), key=repr) == want
