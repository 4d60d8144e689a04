"""Queries on keys of more than five digits against their SQL."""

import pytest

from orograd import catalog

KEYS = {"supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey"}


@pytest.mark.parametrize("name", ["zip_normalize", "zip_priority_merge"])
def test_keys_longer_than_a_zip(spark, tmp_path, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for (t, key), first in zip(KEYS.items(), (99998, 99990, 123450)):
        more = ["concat('n', id) AS c_name"] if t == "customer" else []
        spark.range(first, first + 40).selectExpr(f"id AS {key}", *more).write.parquet(str(tmp_path / f"{t}.parquet"))
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    df = catalog.queries()[name](spark, str(tmp_path))
    want = con.execute(f"select {', '.join(df.columns)} from ({catalog.oracles()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
