"""Answers of drifting form."""

import pytest

from strataq.operators import answers

BODIES = ['{"score": 7, "note": "a"}', '{"score": "8"}', '{"result": {"score": 9.0}, "note": "b"}', '{"score": "high", "note": "c"}', '{"score": null, "note": "d"}', "sorry", "", None, "[1, 2]", '{"score": 7, "note": "a"}']
FIELDS = {"score": ("bigint", ["$.score", "$.result.score"]), "note": ("string", ["$.note"])}


def test_typed_fields_and_the_path_that_failed(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "id int, body string")
    got = [(r.score, r.note, r.failed) for r in answers.typed(df, "body", FIELDS).orderBy("id").collect()]
    assert got == [(7, "a", None), (8, None, "$.note"), (9, "b", None), (None, "c", "$.score"), (None, "d", "$.score"), (None, None, "$"), (None, None, "$"), (None, None, "$"), (None, None, "$.score"), (7, "a", None)]
    with pytest.raises(ValueError):
        answers.typed(df.withColumnRenamed("id", "failed"), "body", FIELDS)


def test_forms(spark):
    df = spark.createDataFrame([(b,) for b in BODIES], "body string")
    got = {r.form: r.n for r in answers.forms(df, "body").collect()}
    assert got[None] == 3 and got["OBJECT<note: STRING, score: BIGINT>"] == 2 and sum(got.values()) == len(BODIES)
    kept = df.where("body like '{%' and body not like '%null%'")
    assert "result: OBJECT" in answers.merged_form(kept, "body").first().form
    assert answers.forms(df.limit(0), "body").count() == 0
