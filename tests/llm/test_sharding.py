from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strataq.llm.sharding import assign_shards, number_slots


def test_growth_moves_rows_only_into_the_new_shard(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    rows = assign_shards(df, "doc_id", [1.0] * 24).collect()
    assert all(r.grown_shard in (r.shard, 24) for r in rows)
    moved = sum(r.grown_shard == 24 for r in rows)
    assert 0.03 < moved / 20000 < 0.05
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 24 and max(sizes.values()) < 1.2 * min(sizes.values())
    more = {r.doc_id: r.shard for r in assign_shards(df, "doc_id", [1.0] * 25).collect()}
    assert all(more[r.doc_id] == r.grown_shard for r in rows)


def test_weights_draw_in_proportion(spark):
    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    sizes = Counter(r.shard for r in assign_shards(df, "doc_id", [1.0, 2.0, 5.0], ()).collect())
    for shard, weight in enumerate((1, 2, 5)):
        assert abs(sizes[shard] / 20000 - weight / 8) < 0.02
    with pytest.raises(ValueError):
        assign_shards(df, "doc_id", [1.0, 0.0])


def test_slots_are_gapless_with_repeats_and_nulls(spark):
    rows = [(i % 50, i % 3) for i in range(400)] + [(7, 0)] * 9000 + [(None, None)] * 5
    df = assign_shards(spark.createDataFrame(rows, "doc_id bigint, size int").repartition(5), "doc_id", [1.0] * 4)
    out = number_slots(df, "doc_id", buckets=8)
    slots = defaultdict(list)
    for r in out.collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = number_slots(df.repartition(3), "doc_id", buckets=8)
    assert out.exceptAll(again).count() == 0
    assert number_slots(df.where(F.lit(False)), "doc_id").count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "doc_id bigint, shard string, grown_shard string")
    got = assign_shards(df, "doc_id", [1.0] * 3)
    assert got.columns == ["doc_id", "shard", "grown_shard"] and {r.shard for r in got.collect()} <= {0, 1, 2}


def test_any_column_names(spark):
    df = spark.createDataFrame([(i % 50, str(i), i, "k") for i in range(200)], "doc_id bigint, _placed string, hash int, c0 string")
    out = number_slots(assign_shards(df, "doc_id", [1.0] * 3).withColumn("n", F.lit(1)).withColumn("_hash", F.lit(2)), "doc_id")
    assert {*df.columns, "shard", "grown_shard", "n", "_hash", "slot"} == set(out.columns)
    assert sorted(tuple(r) for r in out.select(*df.columns).collect()) == sorted(tuple(r) for r in df.collect())
    for shard in range(3):
        slots = sorted(r.slot for r in out.where(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))
