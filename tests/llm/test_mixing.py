from collections import defaultdict
from random import Random

from strataq.llm.mixing import mix, mixed_documents


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def rows_of(rng, n=400):
    out = []
    for i in range(n):
        source = rng.choice(["b", "b", "b", "b", "a", "é", None, "z", "c"])
        out.append((i, " ".join("w" for _ in range(rng.randint(0, 90))) if rng.random() > 0.05 else None, source, "x"))
    return [*out, (None, "a b c", "a", "y"), (None, "a b c", "a", "y"), (5, "p q", "b", "z"), (5, "p q", "b", "z")]


def test_budgets(spark):
    rows = rows_of(Random(3))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string").repartition(4)
    got = mix(df).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    want = targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3
    again = sorted(map(str, mix(df.repartition(2)).collect()))
    assert again == sorted(map(str, got))
    assert mix(df.limit(0)).count() == 0


def test_the_mix_itself(spark):
    rows = rows_of(Random(4))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string")
    taken = defaultdict(int)
    for r in mix(df).collect():
        taken[r.source] += r.taken
    out = mixed_documents(df)
    assert out.columns == df.columns
    words, whole = defaultdict(int), {t for _, t, _, _ in rows}
    cut = 0
    for r in out.collect():
        words[r.source] += len(r.text.split())
        cut += r.text not in whole
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n} and cut <= 12


def test_documents_of_a_mix_with_any_column_names(spark):
    df = spark.createDataFrame([(i, "a b c d", f"s{i % 2}", "x", i) for i in range(20)], "doc_id bigint, text string, source string, row string, _copy int")
    got = mixed_documents(df)
    assert got.columns == df.columns and mixed_documents(df.limit(0)).count() == 0
    assert sum(len(r.text.split()) for r in got.collect()) == 120
