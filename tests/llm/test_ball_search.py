import duckdb
import numpy as np
import pytest

from orograd.llm.ball_search import BallTree, report_sql, search


def by_sql(docs, items, k=50):
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        frame = df.toPandas()
        con.register(name, frame)
    return con.sql(report_sql(k)).fetchall()


def test_tree_equals_brute_force():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 30, 700)
    term = np.concatenate([np.sort(rng.choice(200, n, replace=False)) for n in sizes])
    value = rng.integers(0, 1_000_000, len(term))
    dense = np.zeros((700, 200), dtype=np.int64)
    dense[np.repeat(np.arange(700), sizes), term] = value
    dense[100:400] = dense[100]     # a crowd of equal rows
    ends = np.cumsum((dense > 0).sum(axis=1))
    keep = (dense > 0).any(axis=1)
    dense = dense[keep]
    ends = np.cumsum((dense > 0).sum(axis=1))
    r, c = np.nonzero(dense)
    tree = BallTree(ends, c, dense[r, c], 200, leaf=8)
    for _ in range(60):
        q = rng.choice(200, 12, replace=False)
        w = rng.integers(0, 9000, 12)
        scores = dense[:, q] @ w
        want = sorted([(int(s), k) for k, s in enumerate(scores) if s > 0], key=lambda x: (-x[0], x[1]))
        ids = list(range(len(dense)))
        assert sorted(tree.search(q, w, 20, None, ids), key=lambda x: (-x[0], x[1])) == want[:20]
        least = (want[30][0], want[30][1])  # a bound from elsewhere leaves what is not worse
        got = tree.search(q, w, 50, least, ids)
        assert sorted(got, key=lambda x: (-x[0], x[1])) == want[:31]


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 7}, {"block_docs": 30, "batch_terms": 60}, {"block_docs": 1}])
def test_given_tables_equal_sql(spark, sizes):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    got = search(docs.repartition(3), items, **sizes)
    assert sorted(map(tuple, got.collect())) == sorted(by_sql(docs, items)) and got.count()


def test_odd_rows(spark):
    docs = spark.createDataFrame([
        (1, "Alpha BETA, beta gamma", 1), (2, None, 1), (3, "", 1), (4, "...", 1), (5, "ÀLPHA alpha" + " filler" * 200_000, 1), (7, "beta beta", 1), (6, "beta beta", 1),
        (6, "beta beta", 1), (9, "alpha beta alpha", 1)], "doc_id long, text string, score int")
    items = spark.createDataFrame([(10, "alpha beta"), (11, None), (12, "?!"), (13, "nowhere"), (14, "BETA"), (10, "alpha beta"), (15, "Àlpha filler")],
                                  "item_id long, text string")
    got = sorted(map(tuple, search(docs, items, k=4).collect()))
    assert got == sorted(by_sql(docs, items, 4))
    ties = [r[2] for r in got if r[0] == 14]
    assert ties == [1, 6, 6, 7]
    empty = docs.limit(0)
    assert search(empty, items).collect() == [] and search(docs, items.limit(0)).collect() == []
    assert search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_null_ids_stand_last(spark):
    docs = spark.createDataFrame([(None, "beta"), (2, "beta"), (1, "beta")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "beta")], "item_id long, text string")
    assert [r["doc_id"] for r in search(docs, items, block_docs=1).orderBy("rank").collect()] == [1, 2, None]
