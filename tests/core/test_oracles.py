"""Each registered query of the core against its SQL, on the smallest tables."""

import os

import pytest

from strataq.plans import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, DIR)
    columns = sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    assert rows
    if name in ORACLES:
        found = con.execute(ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr) == rows
