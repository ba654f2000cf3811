"""Changes applied in any order, more than once, late, and over restarts, against one batch."""

from datetime import datetime, timedelta
from random import Random

from strataq.streaming import apply_changes, current_rows
from strataq.streaming.latest import COLUMNS

START = datetime(2024, 1, 1)


def put(spark, rows, path):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(path)


def test_out_of_order_and_repeated_as_in_one_batch(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    draw = Random(5)
    rows = [(draw.choice(["a", "b", "c", "d", None]), v, START + timedelta(minutes=v), draw.choice(["upsert", "upsert", None, "delete"]), draw.choice(["x", "y", "", None])) for v in range(60)]
    rows += [("a", 59, START, "upsert", "tie"), ("e", None, START, "upsert", "x"), ("f", 1, None, "upsert", "x")]
    draw.shuffle(rows)
    for part in (rows[:25], rows[20:50], rows[45:] + rows[:5]):
        put(spark, part, source)
        apply_changes(spark, source, out, mark, late="30 days")
    rank = lambda r: (r[1], r[3] or "upsert", r[4] is not None, r[4] or "")
    usable = [r for r in rows if None not in (r[1], r[2])]
    want = {}
    for key in {r[0] for r in usable}:
        last = max((r for r in usable if r[0] == key), key=rank)
        if last[3] != "delete":
            want[key] = (last[1], last[4])
    assert {r.key: (r.version, r.content) for r in current_rows(spark, out).collect()} == want
    before = current_rows(spark, out).count()
    apply_changes(spark, source, out, mark, late="30 days")  # nothing new
    assert current_rows(spark, out).count() == before


def test_late_changes_and_forgotten_deletes(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    step = lambda *rows: (put(spark, list(rows), source), apply_changes(spark, source, out, mark, late="1 hour", keep_ms=3_600_000))
    at = lambda hours: START + timedelta(hours=hours)
    step(("a", 2, at(0), "delete", None), ("b", 1, at(0), "upsert", "one"))
    step(("a", 1, at(0), "upsert", "older"))  # in time, but of a lower version
    step(("c", 1, at(10), "upsert", "moves the watermark"))
    step(("b", 2, at(1), "upsert", "too late"), ("a", 1, at(1), "upsert", "too late"))
    assert {(r.key, r.version) for r in current_rows(spark, out).collect()} == {("b", 1), ("c", 1)}
    step(("a", 3, at(11), "upsert", "new"))
    assert {(r.key, r.version) for r in current_rows(spark, out).collect()} == {("a", 3), ("b", 1), ("c", 1)}
