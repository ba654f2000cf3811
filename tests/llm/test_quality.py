import subprocess
import sys
from random import Random

import numpy as np
from pyspark.sql import functions as F

from strataq.llm.common import id_remainder
from strataq.llm import quality
from strataq.llm.quality import N_FEATURES, Network, accepted, estimate_prior, fit, score_quality, text_features


def corpus(n, seed):
    rng = Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 90))]
        bad = rng.random() < 0.2
        if bad:
            words = rng.choice([[w + "|" for w in words], [w.upper() + "!!" for w in words], words[:1] * 60])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500, 3)
    truth = dict(labels)
    df = spark.createDataFrame([*rows, (None, None, "y"), (1500, "", "z"), (1500, "", "z")], "doc_id bigint, text string, score string")
    marks = spark.createDataFrame([*labels[:900], (None, 1), (3, None)], "doc_id bigint, quality int")
    got = score_quality(df, marks, id_remainder(F.col("doc_id"), 5) == 0).collect()
    assert len(got) == 1503 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    unseen = [r for r in got if r.doc_id in truth and (r.held_out or r.doc_id >= 900)]
    assert np.mean([r.predicted == truth[r.doc_id] for r in unseen]) > 0.95
    none = score_quality(df, marks.limit(0), id_remainder(F.col("doc_id"), 5) == 0)
    assert {r.score for r in none.collect()} == {0.5}
    assert score_quality(df.limit(0), marks, id_remainder(F.col("doc_id"), 5) == 0).count() == 0


def test_features_and_gradient():
    assert all(len(text_features(t)) == N_FEATURES for t in (None, "", " ", "a b", "é" * 10))
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 5))
    net = Network(x, 4)
    z, slope = net.standard(x), rng.normal(size=20)
    grads = net.gradient(z, slope)
    for k, i in ((0, (1, 2)), (1, (3,)), (2, (0,)), (3, (0,))):
        old, step = net.p[k][i], 1e-6
        net.p[k][i] = old + step
        up = (slope * net.raw(z)).sum()
        net.p[k][i] = old - step
        down = (slope * net.raw(z)).sum()
        net.p[k][i] = old
        assert abs((up - down) / (2 * step) - grads[k][i]) < 1e-4


def test_negatives_are_found_without_negative_labels():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (2000, 3)), rng.normal(4, 1, (400, 3))
    net = fit(good[:1000], np.concatenate([good[1000:], bad]), 1000 / 1400, steps=600)
    assert (net.raw(net.standard(bad)) < 0).mean() > 0.95 and (net.raw(net.standard(good)) > 0).mean() > 0.95


def test_prior_from_positives_and_unlabelled():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.85):
        good, bad = rng.normal(0, 1, (3000, 4)), rng.normal(3, 1, (4000, 4))
        n = int(4000 * share)
        got = estimate_prior(good, np.concatenate([rng.normal(0, 1, (n, 4)), bad[: 4000 - n]])[rng.permutation(4000)])
        assert abs(got - share) < 0.08


def test_negative_labels_are_not_read(spark):
    rows, labels = corpus(400, 5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    score = lambda x: sorted(tuple(r) for r in score_quality(df, spark.createDataFrame(x, "doc_id bigint, quality int"), F.lit(False)).collect())
    assert score(labels) == score([x for x in labels if x[1]])


def test_accepted_with_any_column_names_and_repeated_ids(spark):
    rows, labels = corpus(500, 4)
    truth = dict(labels)
    rows = [(i, t, s, i % 7) for i, t, s in rows] + [(None, rows[0][1], "n", 1), (None, None, "n", 1)]
    good = [i for i in range(500) if truth[i]]
    rows += [(good[0], rows[k][1], "again", 2) for k in good[:200]]  # one labelled id with many texts
    df = spark.createDataFrame(rows, "doc_id bigint, text string, h string, x int").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = accepted(df, marks, F.lit(False))
    assert got.columns == df.columns and accepted(df.limit(0), marks, F.lit(False)).count() == 0
    kept = {r.doc_id for r in got.where("h = 'x'").collect()}
    assert np.mean([(i in kept) == bool(truth[i]) for i in range(500)]) > 0.9
    assert accepted(df, marks.limit(0), F.lit(False)).count() == len(rows)


def plain_features(t):
    """The counts of words, triples and lines, with sets of them."""
    words, lines = t.split(), [x for x in t.split("\n") if x and not x.isspace()]
    w, m, triples = max(1, len(words)), max(1, len(lines)), set(zip(words, words[1:], words[2:], strict=False))
    sizes = [len(x) for x in words] or [0]
    return [np.log1p(len(t.encode())), np.log1p(len(words)), np.mean(sizes), np.std(sizes), max(sizes) / 100, len(set(words)) / w, sum(map(str.__eq__, words, words[1:])) / w, len(triples) / max(1, len(words) - 2), sum(map(str.isupper, words)) / w, len(set(lines)) / m]


def test_features_in_parts(monkeypatch):
    rng = Random(9)
    texts = ["".join(rng.choices(["a", "B", "cd", "é", " ", "\n", "\t", "\u2003", " \n \n"], k=rng.randint(0, 400))) for _ in range(60)] + ["", " ", "x" * 300, "\n" * 50]
    at = [0, 1, 15, 16, 17, 18, 19, 20, 21, 22]
    whole = [text_features(t) for t in texts]
    assert np.allclose([[x[i] for i in at] for x in whole], [plain_features(t) for t in texts])
    monkeypatch.setattr(quality, "_PART", 32)
    assert [text_features(t) for t in texts] == whole


def test_a_very_long_text_is_read_in_bounded_memory():
    code = """
import resource
from strataq.llm.quality import text_features
t = " ".join(f"w{i * 7919 % 9999991} some of it" for i in range(5_500_000))
assert len(t) > 100 << 20
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text_features(t)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < 1 << 20  # KB
