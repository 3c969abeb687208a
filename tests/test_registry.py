"""Every registered query of the engine against its SQL, over the smallest tables where they are installed."""

import os

import pytest

from dialoom.plans import registry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    if name not in SQL:
        return
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({SQL[name]})").fetchall()
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert len(rows) == len(want)
    for a, b in zip(sorted(rows, key=key), sorted(want, key=key)):
        assert a == b


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
