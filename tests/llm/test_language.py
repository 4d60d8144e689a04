import numpy as np

from orograd.llm import entry
from orograd.llm import language as L

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"


def table(spark, rows):
    return spark.createDataFrame([(k, t, g, "x", 1) for k, t, g in rows], SCHEMA)


def test_held_out_accuracy(spark):
    import pandas as pd
    d = "/root/testdata/sf0.01"
    p = entry.op6_language(spark, d).toPandas().merge(pd.read_parquet(f"{d}/documents.parquet")[["doc_id", "lang"]], on="doc_id")
    held = p[p.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98 and p.score.between(0, 1).all()


def test_odd_texts(spark):
    en, de = "the house and the garden with the old tree", "das haus und der garten mit dem alten baum"
    rows = [(1, en, "en"), (2, de, "de"), (3, None, "en"), (4, "", "de"), (5, "123 !!", None), (6, "THE TREE", None), (7, "漢字 かな", None), (1, en, "en"), (None, de, None), (8, en * 20_000, None)]
    df = table(spark, rows)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(df, L.profiles(df)).collect()}
    assert {k: v[0] for k, v in got.items() if k != 7} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en", None: "de", 8: "en"}
    assert got[3][1] == 0.0 and all(0 <= v[1] <= 1 for v in got.values())
    assert {r["lang_pred"] for r in L.identify(df, L.profiles(df.where("false"))).collect()} == {"und"}
    assert L.identify(df.where("false"), L.profiles(df)).count() == 0


def test_long_texts_equal_whole_ones():
    table, text = L._code_table(), "Ein Satz, der sich wiederholt! " * 500
    whole = dict(zip(*(a.tolist() for a in L.trigrams(text, table))))
    old, L.PART = L.PART, 997
    try:
        parts = dict(zip(*(a.tolist() for a in L.trigrams(text, table))))
    finally:
        L.PART = old
    assert parts == whole


def test_bundle_is_the_sum_of_bound_vectors():
    v, table = L.GramVectors(256), L._code_table()
    g, n = L.trigrams("abc abd", table)
    assert np.array_equal(v.bundle(g, n), (v.make(g).astype(float) * n[:, None]).sum(axis=0).astype(np.float32))
    assert set(np.unique(v.make(g))) == {-1, 1}
