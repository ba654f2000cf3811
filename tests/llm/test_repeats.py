import re
from collections import Counter
from hashlib import sha256
from random import Random

import numpy as np
import pytest

from strataq.llm import repeats
from strataq.llm.repeats import cut_repeats, places, tokens


def brute(texts, threshold):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + threshold] for r in raws for i in range(len(r) - threshold + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - threshold + 1):
            if seen[r[i : i + threshold]] > 1:
                gone[i : i + threshold] = True
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((len(r), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), sha256(kept).hexdigest()))
    return out


def brute_passages(texts, passage):
    """(words in repeated runs of `passage` words, maximal runs) of each text."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + passage]) for w in words for i in range(len(w) - passage + 1))
    out = []
    for w in words:
        again = np.zeros(len(w) + 1, bool)
        for i in range(len(w) - passage + 1):
            if seen[tuple(w[i : i + passage])] > 1:
                again[i : i + passage] = True
        out.append((int(again.sum()), int((again[1:] & ~again[:-1]).sum() + again[0])))
    return out


def run(spark, rows, threshold, schema="doc_id bigint, text string", parts=3):
    got = cut_repeats(spark.createDataFrame(rows, schema).repartition(parts), threshold)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=str)


@pytest.mark.parametrize("threshold", [5, 40])
def test_as_brute_force(spark, threshold):
    rng = Random(threshold)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(4)]
    texts = []
    for _ in range(60):
        body = [" ".join(word() for _ in range(rng.randint(0, 25)))]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            i = rng.randint(0, 40)
            body += [s[i : i + rng.randint(3, 90)], word()]
        texts.append(" ".join(body))
    texts += ["the " * 200, "the " * 100, "z" * 300, None, "", "short", texts[0], texts[0]]
    rows = list(enumerate(texts))
    assert run(spark, rows, threshold) == sorted(((i, *x) for i, x in zip(range(len(texts)), brute(texts, threshold), strict=True)), key=str)


@pytest.mark.parametrize("passage", [2, 9, 40])
def test_passages_as_brute_force(spark, passage):
    rng = Random(passage)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    shared = [[word() for _ in range(90)] for _ in range(5)]
    texts = []
    for _ in range(80):
        body = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            i = rng.randint(0, 50)
            body += rng.choice(shared)[i : i + rng.randint(2, 60)] + [word()]
        texts.append("".join(w + rng.choice([" ", "\n", "\t\x0b ", "  "]) for w in body))
    texts += ["the " * 200, "z" * 500, None, "", " ", "\u2003".join(["q"] * 60), texts[0], texts[0]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = cut_repeats(frame, 60, passage).collect()
    assert {r.doc_id: (r.n_repeated_words, r.n_passages) for r in got} == dict(enumerate(brute_passages(texts, passage)))
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(got, key=lambda r: r.doc_id)] == brute(texts, 60)


def test_long_texts_have_the_words_of_short_ones(monkeypatch):
    text = "één två\x0bthree\r\n four " * 50
    short = tokens(text, 1)
    monkeypatch.setattr(repeats, "_SEGMENT", 100)
    assert tokens(text, 1) == short and len(short) == 8 * 200


def test_planted_passages_tell_documents_apart(spark):
    """Passages of 51 to 110 words, 250 to 700 bytes: by words all are found, by 400 bytes the long ones."""
    rng = Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(4000)]
    texts = [rng.choices(words, k=rng.randint(60, 500)) for _ in range(4000)]
    planted = set()
    for _ in range(150):
        passage = rng.choices(words, k=rng.randint(51, 110))
        for i in rng.sample(range(4000), rng.randint(2, 5)):
            at = rng.randint(0, len(texts[i]))
            if i not in planted:
                texts[i][at:at] = passage
                planted.add(i)
    texts = [" ".join(t) for t in texts]
    alone = planted - {i for i, (n, _) in enumerate(brute_passages(texts, 50)) if n}  # others of its passage had one already
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(24)
    got = {r.doc_id: r for r in cut_repeats(frame, 400, 50).drop("kept").collect()}
    assert {i for i, r in got.items() if r.n_repeated_words} == planted - alone
    expected = brute(texts, 400)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[i] for i, r in got.items())
    assert {i for i, r in got.items() if r.n_removed} <= planted


def test_odd_rows(spark):
    text = "abcdefghij" * 3
    rows = [(None, text, "x", 1), (7, text, "y", 2), (7, text, "y", 3), (8, None, None, None), (9, "q" * 9, "", 0)]
    got = run(spark, rows, 12, "doc_id bigint, text string, h string, spans int")
    assert [r[0] for r in got] == [7, 7, 8, 9, None] and [r[2] for r in got] == [30, 30, 0, 0, 30]
    assert run(spark, [], 12) == []


def test_every_window_has_one_place():
    raw = bytes(Random(3).choices(range(4), k=5000))
    place, first, last, _ = places(np.frombuffer(raw, np.uint8), np.array([0, 2000]), np.array([2000, 5000]), 40)
    windows = [p for a, b in zip(first, last, strict=True) for p in range(a, b + 1)]
    assert sorted(windows) == [*range(0, 1961), *range(2000, 4961)]
    assert ((first <= last) & (last <= place) & (place - first <= 20)).all()


def test_parts_of_a_long_text():
    parts = list(repeats._segments([b"x" * (repeats._SEGMENT + 50), b"y" * 30], 20))
    assert [(i, at, len(p)) for g in parts for i, at, p in g] == [(0, 0, repeats._SEGMENT + 19), (0, repeats._SEGMENT, 50), (1, 0, 30)]
