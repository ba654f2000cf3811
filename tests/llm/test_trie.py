import hashlib
import re
import zlib
from collections import defaultdict
from random import Random

from pyspark.sql import functions as F

from strataq.llm import trie
from strataq.llm.trie import prefix_tree

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    convs, members, below = defaultdict(list), defaultdict(list), defaultdict(list)
    for c, n, r, t in rows:
        if c is not None:
            convs[c].append((n is not None, n or 0, r or "", t or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + own[h:]
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    for k in members:
        if k:
            below[k[:-1]].append(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += not below[k]
    ends = lambda k: ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(below[k]), leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in members.items()]


def same(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumns(more).repartition(3)
    got = [tuple(r) for r in prefix_tree(df).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return got


def test_as_brute_force(spark):
    """Copies, chains, shared starts, nulls, repeated turns, absent bases, and columns named as helpers."""
    rng, rows = Random(3), []
    words = ["a", "b c", "", None, "d\te  f", "g"]
    for c in range(300):
        if c % 20 == 0 and c % 40 and rng.random() < 0.5:
            continue  # a decade without its base
        n = rng.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, t, rng.choice(["user", None, ""]), rng.choice(words)) for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(400, 520) for t in range(1, 7)]  # copies
    rows += [(c, t, "user", f"step {t}") for c in range(600, 640) for t in range(c - 599)]  # each goes on from the last
    rows += [(700, None, "user", "x"), (700, None, "user", "x"), (700, 1, "user", "z"), (700, 1, "user", "y"), (None, 0, "user", "lost")]
    same(spark, rows, key=F.lit("k"), rank=F.lit(1), part=F.lit("p"), above=F.lit(None).cast("string"))


def test_long_conversations_and_runs(spark, monkeypatch):
    """Conversations cut over tasks; ends of one node in many runs of ids."""
    monkeypatch.setattr(trie, "_CHUNK", 16)
    rows = [(c, t, "user", f"turn {t}") for c in (0, 1, 40, 45) for t in range(700)] + [(c, 0, "user", "turn 0") for c in range(1000, 1120)]
    same(spark, rows + [(45, 700, "user", "more")])


def test_turnless_and_empty(spark):
    lone = next(c for c in range(1001, 2000) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    assert [r[:2] for r in same(spark, [(lone, 0, "user", "gone")])] == [(lone, 0)]
    assert same(spark, [(None, 0, "user", "x")]) == []
    assert prefix_tree(spark.createDataFrame([], SCHEMA)).collect() == []
