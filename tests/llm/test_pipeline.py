from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
import corpus_pipeline as pipeline
from strataq.llm.common import written

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, folder):
    rng = Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    rows, labels = [], []
    for i in range(240):
        words = [word() for _ in range(80)]
        if i % 6 == 5:
            words = [w + "|" for w in words]
        rows.append([i, " ".join(words), "en", f"s{i % 4}"])
        labels.append((i, int(i % 6 != 5), 0))
    rows[10][1] = rows[4][1] + " extra"
    rows[20][1] += " mail me@site.example.org"
    rows += [[None, " ".join(word() for _ in range(80)), None, None], [300, None, "en", "s1"]]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages(spark, tmp_path):
    d = str(tmp_path)
    rows = tables(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, d), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert sorted(docs.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars"])
    good = {r[0] for r in rows if r[0] is None or r[0] % 6 != 5}
    ids = lambda name: {r.doc_id for r in kept[name]}
    assert ids("quality") - {300} == good - {300}
    assert ids("near_duplicates") == ids("quality") - {10}
    assert len(kept["personal_data"]) == len(kept["near_duplicates"])
    text = {r.doc_id: r.text for r in kept["personal_data"]}
    assert text[20].endswith("mail <email>") and "@" not in "".join(t or "" for t in text.values())
    assert max(Counter(r.doc_id for r in kept["mixing"]).values()) == 2
    assert sum(r.length for r in kept["packing"] if r.start == 0) > 0
    assert len(pipeline.run(spark, d).collect()) == len(kept["packing"])


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls in every column, columns that clash with helpers' names, and no rows at all."""
    d = str(tmp_path)
    tables(spark, d)
    given = spark.read.parquet(f"{d}/documents.parquet")
    extra = {"_h": F.lit("k"), "row": F.lit(1), "x": F.lit(None).cast("string"), "key": F.lit(2.0), "spans": F.array(F.lit("s"))}
    odd = given.withColumns(extra).unionByName(given.limit(3).select(*[F.lit(None).cast(t).alias(c) for c, t in given.dtypes]).withColumns(extra))
    for docs in (odd, odd.limit(0)):
        empty = docs.isEmpty()
        for name, stage in pipeline.STAGES:
            docs = written(stage(spark, docs, d), name)
            assert docs.isEmpty() == empty, name
            if name != "packing":
                assert docs.columns == odd.columns, name
