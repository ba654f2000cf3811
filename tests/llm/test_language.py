from random import Random

import numpy as np
from pyspark.sql import functions as F

from strataq.llm.common import id_remainder
from strataq.llm.language import SEGMENT, BiGRU, identify


def test_gradient_through_time():
    net = BiGRU(["a", "b", "c"], hidden=3)
    net.p = [x.astype(np.float64) for x in net.p]
    rng = np.random.default_rng(0)
    x, label = rng.integers(0, 5, (4, 6)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grads = net.gradient(x, label)
    for k, p in enumerate(net.p):
        for i in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(4)] + ([(0, int(x[0, 2]), 1), (1, int(x[1, 3]), 7)] if k == 0 else []):
            old = p[i]
            p[i] = old + 1e-3
            up = net.gradient(x, label)[0]
            p[i] = old - 1e-3
            down = net.gradient(x, label)[0]
            p[i] = old
            assert abs((up - down) / 2e-3 - grads[k][i]) < 2e-4, (k, i)


def test_documents_pool_all_positions():
    net = BiGRU(["a", "b"])
    texts = [b"x" * 10, b"", b"hello " * 100, bytes(range(256))]
    got = net.documents(texts)
    read = lambda t: net.positions(net.states(np.frombuffer(t, np.uint8)[None]))[:, 0]
    for t, row in zip(texts, got, strict=True):
        whole = len(t) // SEGMENT * SEGMENT
        want = sum((read(t[i : i + SEGMENT]).sum(0) for i in range(0, whole, SEGMENT)), np.zeros(2))
        if len(t) > SEGMENT and len(t) > whole:
            want += read(t[-SEGMENT:])[whole - len(t) :].sum(0)
        elif len(t) > whole:
            want += read((t * SEGMENT)[:SEGMENT])[: len(t)].sum(0)
        assert np.allclose(row, want / max(1, len(t)), atol=1e-4)


def test_held_out_accuracy(spark):
    rng = Random(8)
    letters = {"xx": "abcdeé", "yy": "klmnoß", "zz": "aeiouk"}
    rows = [(i, " ".join("".join(rng.choices(letters[k], k=rng.randint(2, 7))) for _ in range(rng.randint(8, 60))), k, "q") for i, k in enumerate(rng.choices(list(letters), k=600))]
    odd = [(None, None, None, "r"), (900, "", "xx", "s"), (901, "12 34!", "yy", None), (902, "a", None, "t"), (902, "a", None, "t")]
    df = spark.createDataFrame([*rows, *odd], "doc_id bigint, text string, lang string, score string")
    mark = id_remainder(F.col("doc_id"), 4) == 2
    got = identify(df, mark).collect()
    truth = {i: k for i, _, k, _ in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 605 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (None, 900, 901)) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in identify(df.withColumn("lang", F.lit(None)), mark).collect()} == {"und"}
    assert identify(df.limit(0), mark).count() == 0


def test_ids_that_are_null_or_repeated_teach_all_languages(spark):
    rng = Random(4)
    letters = {"xx": "abcdefg", "yy": "nopqrst", "zz": "àéîöüß "}
    text = lambda k: " ".join("".join(rng.choices(letters[k], k=rng.randint(2, 7))) for _ in range(25))
    rows = [(None, text("xx"), "xx") for _ in range(60)] + [(5, text("yy"), "yy") for _ in range(60)] + [(i, "üß éà öî " * 9, "zz") for i in [7] * 3000]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = identify(df, F.lit(False), most=40).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} == {"xx", "yy", "zz"}
