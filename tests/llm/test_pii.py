import re
from hashlib import sha256
from random import Random

import pytest
from pyspark.sql import functions as F

from strataq.llm.pii import digest_columns, mask_documents, masked, personal_data


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    t = text or ""
    n = lambda s: len(re.sub("[^0-9]", "", s))
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= n(s) <= 19 and luhn(re.sub("[^0-9]", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= n(s) <= 15),
    ]
    found = [(m.start(), r, k, m.end()) for r, (k, p, ok) in enumerate(rules) for m in re.finditer(p, t) if ok(m.group())]
    return sorted(found)


def expected(text):
    found = brute(text)
    counts = [sum(k == kind for _, _, k, _ in found) for kind in ("email", "ip", "card", "phone")]
    return (*counts, sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in found).encode()).hexdigest())


PARTS = ["a.b@c.de", "@", "x@y", ".", "..", "-", " ", "  ", "1.2.3.4", "256.1.1.1", "007.1.2.3.4.5", "4539578763621486", "4539 5787-6362 1486", "1-2", "+49 (30) 123-45.67", "+", "é", "😀", "\n", "\x01", "a@b..c", "z%+x@q-.w-", "12", "_", "(", "A@b.c@d.e", "0"]


def test_base_as_brute_force(spark):
    rng = Random(11)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(600)]
    texts += [None, "", "9" * 30000, "1 " * 20000, "a." * 20000 + "@" + "b." * 20000 + "c", "+1" + "(" * 20000, "x" * 50000, "1." * 20000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:6] for r in digest_columns(personal_data(df)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == expected(t), (t or "")[:80]


def test_patterns_find_unseen(spark):
    rng = Random(2)
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n - 2)) + "a1"
    rows = [(i, f'Words é here token = "{hexa(40)}" and more') for i in range(20)]
    rows += [(100 + i, f"note badge: {hexa(40)} seen") for i in range(8)]  # no credential word; the shape is known
    rows += [(200 + i, f"room {1000000 + 17 * i} on floor7 of abc{i}def") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in personal_data(df).collect()}
    text = dict(rows)
    for i in [*range(20), *range(100, 108)]:
        assert [text[i][s.start : s.end] for s in got[i].spans] == [re.search("[0-9a-f]{40}", text[i]).group()]
    assert all(not got[200 + i].spans for i in range(8))


def test_base_kinds_find_unseen(spark):
    """Labels of base spans find what no form names: with separators, short, long, of digits alone."""
    unseen = {
        "email": ("write to: {}", [f"user{i}.x{i}@mail{i}.example.com" for i in range(30)], ["ann.lee77(at)example.com", "root@localhost", "x" * 140 + "9@intern"]),
        "ip": ("host: {}", [f"10.{i}.7.{i + 1}" for i in range(30)], ["fe80::1ff:fe23:4567:890a"]),
        "phone": ("call phone: {}", [f"+1 ({i + 100}) 555-0{i + 100}" for i in range(30)], ["(052) 555-0934", "0305559876", "5550"]),
    }
    docs, want, n = [], {}, 0
    for kind, (frame, seeds, others) in unseen.items():
        for value in [*seeds, *others]:
            docs.append((n, "Some words before; " + frame.format(value) + " and after"))
            want[n] = [(kind, value)]
            n += 1
    for i in range(30):  # numbers that the check of cards rejects, after words of all kinds
        digits = str(4539578763621000 + 37 * i)
        docs.append((n, f"seen of {digits} there"))
        want[n] = [("card", digits)] if luhn(digits) else []
        n += 1
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    text = dict(docs)
    for r in personal_data(df).collect():
        assert [(s.kind, text[r.doc_id][s.start : s.end]) for s in r.spans] == want[r.doc_id]


def test_odd_rows(spark):
    rows = [(None, "me a@b.co", 1, "x"), (1, None, 2, "y"), (2, "me a@b.co", 3, None), (2, "me a@b.co", 3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, base int, spans string")
    got = sorted(((r.doc_id, r.n_email, r.spans) for r in digest_columns(personal_data(df)).collect()), key=str)
    assert got == [(1, 0, ""), (2, 1, "email:3:9"), (2, 1, "email:3:9"), (None, 1, "email:3:9")]
    assert personal_data(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["mail a@b.co now", "no", "+1 234 567 89 01 and 1.2.3.4"])
def test_masked(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = df.join(personal_data(df), "doc_id").select(masked(F.col("text"), F.col("spans"))).first()[0]
    want, at = "", 0
    for a, _, k, b in brute(text):
        if a >= at:
            want += text[at:a] + f"<{k}>"
        at = max(at, b)
    assert row == want + text[at:]


def test_many_spans_in_one_text(spark):
    rng = Random(5)
    text = " ".join(rng.choice([str(rng.randrange(10**7)), f"u{i}@x{i}.co", "wörd", f"10.0.{i % 300}.1", "+49 30 1234567,"]) for i in range(30000))
    df = spark.createDataFrame([(1, text), (2, "one@mail.de"), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:6] for r in digest_columns(personal_data(df)).collect()}
    assert got == {1: expected(text), 2: expected("one@mail.de"), 3: expected("")}
    row = df.where("doc_id = 1").join(personal_data(df), "doc_id").select(masked(F.col("text"), F.col("spans")), "spans").first()
    want, at = [], 0
    for s in row.spans:
        if s.start >= at:
            want += [text[at : s.start], f"<{s.kind}>"]
        at = max(at, s.end)
    assert row[0] == "".join(want) + text[at:]


def test_masking_with_any_column_names(spark):
    names = ["_h", "_hash", "_id", "_spans", "h", "spans", "row", "found_id"]
    df = spark.createDataFrame([(1, "me a@b.co", *names), (None, "x 1.2.3.4", *names), (2, None, *names), (3, "", *names)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = mask_documents(df)
    assert out.columns == df.columns and mask_documents(df.limit(0)).count() == 0
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([(1, "me <email>", *names), (None, "x <ip>", *names), (2, None, *names), (3, "", *names)], key=str)
