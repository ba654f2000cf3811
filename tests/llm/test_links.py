import duckdb
import pytest
from pyspark.sql import functions as F

from strataq.llm.links import judge, longest_rule, url_parts
from strataq.llm.queries import ORACLES

SCHEMA = "page_id bigint, url string, html string"


def link(*hosts):
    return "".join(f'<a class="x" HREF = "https://{h}/p?q#f">y</a>' for h in hosts)


ROWS = [
    (1, "https://Bad.example.NET/es/1", link("worse.org")),
    (2, "http://bad.example.net/fr/2?x=//y", None),
    (3, "https://near.org/a", link("bad.example.net", "BAD.example.net:80")),  # one of two is another host by its port
    (4, "https://fan.org/a", link("bad.example.net")),
    (5, "https://fan.org/b", "<a href=//bad.example.net>x</a> <a href='/own'>y</a>"),
    (6, "https://far.org/", link("fan.org")),
    (7, "https://good.com/x", link("liked.org", "fan.org")),
    (8, "https://good.com/y", link("liked.org")),
    (9, "https://liked.org/x", link("fan.org")),
    (10, "https://worse.org/x", ""),
    (11, None, link("bad.example.net")),
    (12, "no url", ""),
    (13, "https://www.example.com/en/x", ""),
    (14, "https://a.www.example.com/en/x", ""),
    (15, "https://b.example.com/en/#x", ""),
    (16, "https://b.example.com", ""),
    (17, "https://notexample.com/en/", ""),
    (18, "ftp://x.net/es/", ""),
    (19, "https://x.net/es", ""),
    (None, "https://fan.org/b", ""),
    (5, "https://fan.org/b", "<a href=//bad.example.net>x</a>"),
]


def test_verdicts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.page_id, r.url): r for r in judge(df).collect()}
    verdict = {i: r.verdict for (i, _), r in got.items()}
    rule = {i: r.rule for (i, _), r in got.items()}
    assert (got[(1, ROWS[0][1])].host, got[(2, ROWS[1][1])].path) == ("bad.example.net", "/fr/2")
    assert [rule[i] for i in range(13, 20)] == ["www.example.com/en/", "www.example.com/en/", "example.com/en/", None, "com/", "net/es/", None]
    assert (rule[1], verdict[1], verdict[13], verdict[15]) == ("net/es/", "block", "allow", "block")
    # fan links to a blocked host alone, far to fan (0.85 squared); near to it by half, liked is trusted, worse is linked from a blocked host only
    assert [verdict[i] for i in (4, 5, 6)] == ["block"] * 3 and [verdict[i] for i in (3, 7, 10, 11, 12)] == ["allow"] * 5


def test_as_sql(spark):
    con = duckdb.connect()
    df = spark.createDataFrame(ROWS, SCHEMA)
    con.register("pages", df.toPandas())
    want = sorted(con.execute(ORACLES["op12_url_verdicts"]).fetchall(), key=repr)
    got = sorted((tuple(r) for r in judge(df).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert got == [tuple(None if x != x else int(x) if i == 0 and x is not None else x for i, x in enumerate(r)) for r in want]


def test_seeds_clashes_and_empty(spark):
    clash = {c: F.lit("z") for c in ("host", "path", "rule", "verdict", "row", "said", "bad", "src", "dst")}
    df = spark.createDataFrame([(1, "https://a.org/x", link("b.org")), (2, "https://b.org/x", None)], SCHEMA).withColumns(clash)
    seeds = spark.createDataFrame([("b.org", 0.0, 1.0)], "host string, trust double, distrust double")
    got = judge(df, seeds=seeds)
    assert sorted(got.columns) == sorted(df.columns) and {r.page_id: r.verdict for r in got.collect()} == {1: "block", 2: "block"}
    assert {r.page_id: r.verdict for r in judge(df).collect()} == {1: "allow", 2: "allow"}
    assert judge(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="seeds"):
        longest_rule(F.col("a"), F.col("b"), [("allow", str(i), "/") for i in range(1001)])
    assert len(url_parts(F.col("url"))) == 2
