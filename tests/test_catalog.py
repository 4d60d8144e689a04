"""Every registered query against its SQL, run by DuckDB on the same tables."""

import datetime as dt

import pytest

from orograd import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def value(x):
    return x.isoformat(" ") if isinstance(x, dt.datetime) else repr(x)


def close(a, b):
    """Equal text, or floats apart by one unit of the last rounded digit."""
    if a == b:
        return True
    try:
        return abs(float(a) - float(b)) <= 2e-5 * max(1.0, abs(float(a)))
    except ValueError:
        return False


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    rows, cols = df.collect(), sorted(df.columns)
    if name not in ORACLES:
        assert rows
        return
    res = duck.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert cols == sorted(names)
    got = sorted(tuple(value(r[c]) for c in cols) for r in rows)
    at = [names.index(c) for c in cols]
    want = sorted(tuple(value(r[i]) for i in at) for r in res.fetchall())
    assert len(got) == len(want)
    left, right = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    assert len(left) == len(right) and all(close(a, b) for x, y in zip(left, right) for a, b in zip(x, y)), (left[:3], right[:3])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
