import re
from collections import Counter
from random import Random

from pyspark.sql import functions as F

from strataq.llm import rules
from strataq.llm.common import in_share, share_bound
from strataq.llm.rules import decide, statistics


def brute(text):
    x = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", x)
    grams = list(zip(w, w[1:], w[2:], strict=False))
    seen, repeated = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [line for line in x.split("\n") if re.search(r"[^\x20\x09-\x0d]", line)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(repeated)


def test_statistics_as_brute_force(spark):
    rng = Random(4)
    texts = ["".join(rng.choice(["a", "b", "é😀", "#", "|x"]) + rng.choice([" ", "\n", "\t", "  ", "\n \n"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", " ", "a", "a b", "a b c", "a b c " * 5000, "x " * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:6] for r in statistics(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_learns_a_list(spark):
    rng = Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(80)]
        bad = i % 5 == 0
        if bad and i % 2:
            words = [w + "|" for w in words]
        elif bad:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), "x"))
        labels.append((i, None if i % 7 == 0 else int(not bad)))
    df = spark.createDataFrame([*rows, (None, None, "y"), (1000, "few words", "z")], "doc_id bigint, text string, kept string")
    marks = spark.createDataFrame([*labels, (None, 1), (1, 1)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in decide(df, marks).collect()}
    assert all(got[i].kept == (i % 5 != 0) for i in range(600))
    assert got[None].base_failed and not got[1000].kept
    plain = decide(df, marks.limit(0))
    assert plain.where(F.col("kept") == F.col("base_failed")).count() == 0 and decide(df.limit(0), marks).count() == 0


def test_texts_of_more_places_than_bits(spark, monkeypatch):
    monkeypatch.setattr(rules, "_POSITION_BITS", 4)
    rng = Random(8)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (10, 15, 16, 17, 18, 40, 300)] + ["a b c d " * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: tuple(r)[1:6] for r in statistics(df).collect()} == {i: brute(t) for i, t in enumerate(texts)}


def test_small_shares_are_not_cut_to_nothing(spark):
    assert share_bound(1e-9) + (1 << 63) == int(1e-9 * 2**64) > 0 and share_bound(0.0) == -(1 << 63) and share_bound(1.0) == (1 << 63) - 1
    n = 4_000_000
    found = spark.range(n).where(in_share(F.col("id"), 1, 1e-5)).count()  # a grain of 2^-20 would round this share up or down by a tenth
    assert 10 < found < 90 and spark.range(50).where(in_share(F.col("id"), 1, 1.0)).count() == 50
