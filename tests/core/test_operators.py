from collections import Counter
from random import Random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataq.functions import normalised
from strataq.operators import agent, augment, difficulty, loop, review, sync
from strataq.sources.service import Sent, TableReader, TableService, TableWriter
from strataq.streaming import event_windows, incremental


def test_pairs_and_review(spark):
    rows = [(1, 0, "user", "Why é?"), (1, 1, "assistant", "x" * 30), (1, 2, "user", "unanswered"), (2, 0, "user", None), (2, 1, "assistant", ""), (3, 0, "assistant", "first"), (4, 0, "user", "mail a@b.co please"), (4, 1, "assistant", "Mail A@B.co  please")]
    talk = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pairs = review.question_pairs(talk)
    assert sorted((r.conv_id, r.turn) for r in pairs.collect()) == [(1, 0), (2, 0), (4, 0)]
    reasons = {r.reasons for r in review.review(pairs).collect()}
    assert reasons == {"", "empty,short,echo", "short,echo,personal"}
    assert review.question_pairs(talk.limit(0)).count() == 0


def test_near_duplicate_classes_as_brute_force(spark):
    rng = Random(9)
    texts = []
    for _ in range(10):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.randint(8, 60))]
        for _ in range(5):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "z"
            texts.append(" ".join(copy))
    texts += ["", "one two", "one two", "One two!", None, None]
    rows = list(enumerate(texts))
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} if t else set()
    sets = {i: frozenset(grams(t)) for i, t in rows}
    key = {i: s or t for (i, t), s in zip(rows, sets.values(), strict=True)}
    cls = {i: min(j for j in sets if key[j] == key[i]) for i in sets}
    heads = {c for c in cls.values() if sets[c]}
    links = Counter(a for a in heads for b in heads if a != b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = review.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, cls[i], links[cls[i]]) for i in sets)



def test_near_duplicate_windows_are_written_once(spark, monkeypatch):
    """all windows were written with the documents and again with the classes, and each was shuffled to count it and to rank it."""
    arrays, rows, real = [], [], review.written

    def written(df):
        out = real(df)
        arrays.append(out.selectExpr("coalesce(sum(size(items)), 0)").first()[0] if "items" in out.columns else 0)
        rows.append(out.count() if "item" in out.columns else 0)
        return out

    monkeypatch.setattr(review, "written", written)
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(104))) for i in range(30)], "doc_id bigint, text string")
    assert {(r.doc_id, r.class_id, r.n_links) for r in review.near_duplicate_classes(docs).collect()} == {(i, i, 0) for i in range(30)}
    assert sum(arrays) == 3000  # 100 windows a text
    assert max(rows) == 30 * 21  # of which the first 21 are looked for


def test_long_near_duplicates(spark):
    """Sets of some 1,500 windows with a common passage: two are alike, others are told apart before their sets are fetched."""
    text = lambda k, odd=0: " ".join([f"c{i}" for i in range(400)] + [f"{'z' if odd and i < odd else 'w'}{k}x{i}" for i in range(1100)])
    texts = [text(1), text(1, 50), text(2), text(3), text(1, 600), text(2, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(map(tuple, review.near_duplicate_classes(docs).collect())) == [(0, 0, 1), (1, 1, 1), (2, 2, 1), (3, 3, 0), (4, 4, 0), (5, 5, 1)]
    pairs = spark.createDataFrame([(a, b, 2992) for a in range(6) for b in range(a + 1, 6)], "a bigint, b bigint, both int")
    sets = docs.select(F.col("doc_id").alias("class_id"), review.window_hashes(review.words(F.col("text")), 5).alias("items"))
    assert sorted(map(tuple, review._alike_by_wide_parity(pairs, sets, 80).collect())) == [(0, 1), (2, 5)]


@pytest.mark.parametrize("loads", [64, 128, 1 << 18])
def test_near_duplicates_whatever_is_held_often(spark, monkeypatch, loads):
    """The order of windows is a matter of cost alone, with a common passage in all texts too."""
    monkeypatch.setattr(review, "_LOADS", loads)
    rng = Random(3)
    common = " ".join(f"c{i}" for i in range(12))
    texts = []
    for _ in range(8):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(40, 90))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "z"
            texts.append(f"{common} {' '.join(copy)} {common}")
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    first = [sets.index(s) for s in sets]
    classes = set(first)
    links = {c: sum(c != d and 100 * len(sets[c] & sets[d]) >= 80 * len(sets[c] | sets[d]) for d in classes) for c in classes}
    got = review.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, got)) == [(i, c, links[c]) for i, c in enumerate(first)]
    assert any(links.values())


def test_contamination_of_any_length(spark):
    items = ["alpha beta gamma delta epsilon zeta eta theta", "short one", "pre fix 1 2 3 4 5 post", "three little words", "two inner words here", "x"]
    docs = ["x " + items[0] + " y", "glued" + items[0] + "end", "a short one b", items[2][2:], "é " + items[2] + "ed", "", "athree little wordsy two inner words herex", "three little", "two inner words"]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = sorted(tuple(r) for r in review.contaminated(d, b).collect())
    assert got == sorted((i, j) for i, x in enumerate(docs) for j, y in enumerate(items) if y in x)


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.text("abc", max_size=3)), st.dictionaries(st.integers(0, 30), st.text("abc", max_size=3)))
def test_applying_changes_gives_the_current(spark, current, previous):
    frame = lambda x: spark.createDataFrame(list(x.items()), "doc_id bigint, text string")
    c, p = frame(current), frame(previous)
    got = {r.doc_id: r.text for r in sync.applied(p, c, sync.changes(c, p)).collect()}
    assert got == current


def test_normalising_twice_changes_nothing(spark):
    df = spark.createDataFrame([(t,) for t in ("  A\t b ", "", "É  é\n", "x")], "t string").withColumn("a", normalised(F.col("t")))
    assert df.where(normalised(F.col("a")) != F.col("a")).count() == 0


def test_a_call_for_each_request_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def client(stage, payload):
        with open(log, "a") as f:
            f.write(payload + "\n")
        if payload == "p3":
            raise RuntimeError("down")
        return '{"score": 5, "question": "q"}'

    rows = spark.createDataFrame([(f"p{i % 10}",) for i in range(40)], "p string")
    wanted = agent.requests(rows, "s", "1", "p")
    out = agent.run_stage(spark, wanted, str(tmp_path / "out"), client)
    calls = lambda: Counter(open(log).read().split())
    assert calls() == Counter({f"p{i}": 1 for i in range(10)}) and out.where("status = 'failed'").count() == 1
    again = agent.run_stage(spark, wanted, str(tmp_path / "out"), client)
    assert calls()["p3"] == 2 and sum(calls().values()) == 11
    assert agent.parsed(again).where("ok").count() == 9
    rows = {r.request_id: r for r in again.collect()}  # one row a request, attempts counted
    assert len(rows) == again.count() == 10 and sorted(r.attempt for r in rows.values()) == [1] * 9 + [2]
    third = agent.run_stage(spark, wanted, str(tmp_path / "out"), client, tries=2, most_attempts=3)
    assert calls()["p3"] == 4 and third.where("status = 'failed'").first().attempt == 4
    agent.run_stage(spark, wanted, str(tmp_path / "out"), client, most_attempts=3)
    assert calls()["p3"] == 4


def test_families_stay_together(spark):
    pairs = spark.createDataFrame([(i, 0, f"question number {i}", "a") for i in range(300)], "conv_id bigint, turn bigint, question string, answer string")
    family = augment.with_lineage(pairs)
    parts = augment.split(family, 20000).join(family.select("question_id", F.coalesce("parent_id", "question_id").alias("f")), "question_id")
    assert parts.groupBy("f").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0
    assert family.select("question_id").distinct().count() == 1500


ROW = "doc_id bigint, op string, content_hash string"


def read_service(spark, path):
    spark.dataSource.register(TableService)
    return [tuple(r)[:2] for r in spark.read.format("table_service").option("path", path).load().orderBy("write_no", "row_no").collect()]


def send_rows(spark, path, rows, mode="append", **options):
    spark.dataSource.register(TableService)
    df = spark.createDataFrame([(*r, "x") for r in rows], ROW).coalesce(1)
    df.write.format("table_service").option("path", path).options(**options).mode(mode).save()


def test_what_is_sent_again_counts_again_and_in_order(spark, tmp_path):
    path = str(tmp_path / "remote")
    assert read_service(spark, path) == []
    changes = [(1, "insert"), (1, "delete"), (1, "insert")]
    for c in changes:
        send_rows(spark, path, [c])
    assert read_service(spark, path) == changes
    for _ in range(2):  # one write under one name
        send_rows(spark, path, [(2, "insert")], write_id="week 1")
    assert read_service(spark, path) == [*changes, (2, "insert")]
    send_rows(spark, path, [(4, "insert"), (5, "insert"), (3, "insert")], "overwrite")
    send_rows(spark, path, [(6, "insert")])
    assert read_service(spark, path) == [(4, "insert"), (5, "insert"), (3, "insert"), (6, "insert")]


def test_abort_takes_only_its_own(spark, tmp_path):
    path = str(tmp_path / "remote")
    row = {"doc_id": 3, "op": "insert", "content_hash": "x"}
    one, two = (TableWriter(path, list(row)) for _ in range(2))
    a, b = one.write(iter([row])), two.write(iter([row]))  # the same batch by two writers at once
    one.abort([a, None])
    two.commit([b])
    two.abort([b])  # too late: it counts
    TableWriter(path, list(row)).abort([])
    assert read_service(spark, path) == [(3, "insert")]


def test_batches_are_requests_of_bounded_size_and_tasks_take_many(spark, tmp_path):
    path = f"file://{tmp_path}/remote"
    spark.dataSource.register(TableService)
    rows = spark.createDataFrame([(i, "insert", "x") for i in range(250)], ROW)
    for _ in range(2):
        sync.send(sync.batches(rows, size=40, lanes=3), path, write_id="first")
    files = list((tmp_path / "remote/writes").glob("*/*.jsonl"))
    assert len(files) >= 7 and sorted(i for i, _ in read_service(spark, path)) == list(range(250))
    assert sync.batches(rows, rows_a_lane=100).select("lane").distinct().count() == 3
    small = TableWriter(path, ["doc_id"], most_rows=1)  # 100,000 requests
    small.commit([Sent(part, 0, 1000, 1000) for part in range(100)])
    parts = TableReader(path, []).partitions()
    assert len(parts) <= 4 and sum(end - at for p in parts for _, _, _, at, end in p.value) == 100_000 + len(files)
    big = TableWriter(str(tmp_path / "big"), ["doc_id"])
    big.commit([Sent(0, 0, 900, 900_000)])  # one task of many files is read by many
    assert len(TableReader(str(tmp_path / "big"), []).partitions()) >= 15


def test_a_done_answer_beats_a_failed_one(spark):
    rows = [("a", "done", "x", None, 1), ("a", "failed", None, "e", 1), ("a", "failed", None, "e", 2), ("b", "failed", None, "e", 1), ("b", "failed", None, "f", 2)]
    got = {r.request_id: r for r in agent.latest(spark.createDataFrame(rows, agent.ANSWER)).collect()}
    assert got["a"].body == "x" and got["b"].error == "f"


def test_refine_settles_each_question(spark, tmp_path):
    """accepted, given up, revised, unreadable, unanswered and over budget, with what each was charged."""
    questions = spark.createDataFrame([(q, q + " draft") for q in ("good", "bad", "slow", "odd", "mute", "dear", "long")] + [("none", None)], "question_id string, draft string")
    says = lambda score, q="next one": f'{{"score": {score}, "question": "{q}"}}'
    answers = [("good", 1, says(90)), ("bad", 1, says(3)), ("slow", 1, says(50)), ("slow", 2, says(70)), ("odd", 1, "sorry"), ("odd", 2, says(99)), ("dear", 1, says(50, "one two three four five six seven")), ("none", 1, says(80))]
    answers += [("long", i, says(50, "x")) for i in range(1, 9)]
    ask = loop.recorded(spark.createDataFrame(answers, "question_id string, round int, body string"))
    words = lambda t: F.size(F.split(t, " "))
    got = {r.question_id: tuple(r)[1:] for r in loop.refine(spark, questions, str(tmp_path / "run"), ask, loop.by_score(), words, 8, 4).collect()}
    assert got == {
        "good": ("accepted", 1, 2, "good draft"), "bad": ("given_up", 1, 2, "bad draft"), "slow": ("accepted", 2, 4, "next one"), "odd": ("accepted", 2, 4, "odd draft"),
        "mute": ("unanswered", 1, 2, "mute draft"), "dear": ("over_budget", 1, 2, "one two three four five six seven"), "long": ("open", 4, 5, "x"), "none": ("accepted", 1, 1, ""),
    }


def test_refine_goes_on_after_a_kill_and_never_exceeds_its_ledger(spark, tmp_path):
    path, calls = str(tmp_path / "run"), []
    questions = spark.createDataFrame([(f"q{i}", "a b") for i in range(30)], "question_id string, draft string")

    def ask(asked):
        rows = asked.collect()
        calls.extend(r.request_id for r in rows)
        if len(calls) in (30, 90):  # killed after the calls, before any answer was kept
            raise RuntimeError("killed")
        return spark.createDataFrame([(r.request_id, '{"score": 50, "question": "a b"}') for r in rows], "request_id string, body string")

    run = lambda: loop.refine(spark, questions, path, ask, loop.by_score(), lambda t: F.lit(2), 12, 5, total=290)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            run()
    last = run()
    charged = spark.read.parquet(f"{path}/ledger").agg(F.sum("price")).first()[0]
    assert 2 * len(calls) <= charged == 290 and {r.spent for r in last.collect()} == {10, 8}
    n = len(calls)
    assert sorted(map(tuple, run().collect())) == sorted(map(tuple, last.collect())) and len(calls) == n


def test_null_content_is_not_empty(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sync.changes(frame([(1, ""), (2, None), (3, None), (4, None)]), frame([(1, None), (2, ""), (3, None), (5, None)]))
    assert {(r.doc_id, r.op) for r in got.collect()} == {(1, "update"), (2, "update"), (4, "insert"), (5, "delete")}


def test_neighbours_as_brute_force(spark):
    rng = Random(3)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(90)] + [(90, [0.0] * 4), (91, None), (92, [1.0, 2.0]), (93, [2.0, 4.0]), (95, [1e-200, 0.0]), (96, [1e200, 1e200])]
    odd = [(97, [float("nan"), 1.0]), (98, [float("inf"), 0.0]), (99, [None, 1.0])]
    df = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<double>")
    vectors = [(i, v and [x / max(map(abs, v)) if any(v) else x for x in v]) for i, v in vectors]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    use = {i: v for i, v in vectors if v and any(v)}
    want = []
    for q in use:
        near = sorted((-round(dot(use[q], v) / (dot(use[q], use[q]) * dot(v, v)) ** 0.5, 5), i) for i, v in use.items() if i != q and len(v) == len(use[q]))
        want += [(q, n + 1, i, -x) for n, (x, i) in enumerate(near[:5])]
    assert sorted(tuple(r) for r in difficulty.neighbours(df, df, 5, 20).collect()) == sorted(want)


def test_bands_as_windows(spark):
    turns = spark.createDataFrame([(i, i % 3, "ab"[i % 7 == 0], "x" * (i * 7 % 11)) for i in range(103)] + [(500, 0, "c", None)] + [(5000 + 3000 * i, 0, ("", None)[i % 2], "x") for i in range(20)], "conv_id bigint, turn bigint, role string, text string")
    turns.createOrReplaceTempView("turns")
    want = spark.sql("SELECT conv_id, turn, cast(ntile(5) OVER w AS bigint), round(percent_rank() OVER w, 6) FROM turns WINDOW w AS (PARTITION BY role ORDER BY length(text), conv_id, turn)")
    assert sorted(map(tuple, difficulty.relative_bands(turns).collect())) == sorted(map(tuple, want.collect()))


def test_incremental_runs_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    spark.range(5).coalesce(1).write.parquet(src)
    assert incremental(spark, src, "id bigint", out, mark) == 1
    spark.range(5, 8).coalesce(1).write.mode("append").parquet(src)
    assert incremental(spark, src, "id bigint", out, mark) == 1
    assert sorted(r.id for r in spark.read.parquet(f"{out}/*").collect()) == list(range(8))


def test_late_events_are_dropped_in_a_stream(spark, tmp_path):
    schema = "ts timestamp, event_type string, value double"
    src = str(tmp_path / "events")
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    steps = [["2024-01-01 00:10:00"], ["2024-01-01 03:00:00"], ["2024-01-01 00:20:00"], ["2024-01-01 06:00:00"]]
    for times in steps:
        spark.createDataFrame([(t, "a", 1.0) for t in times], "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(f"{src}")
        windows = event_windows(spark.readStream.schema(schema).parquet(src), "1 hour", "10 minutes")
        windows.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    got = {(str(r.start), r.n) for r in spark.read.parquet(out).collect()}
    assert got == {("2024-01-01 00:00:00", 1), ("2024-01-01 03:00:00", 1)}  # the event of 00:20 came after its window had closed


def test_unknown_table(spark):
    from strataq.sources import load

    with pytest.raises(ValueError):
        load(spark, "/nowhere", "nothing")
