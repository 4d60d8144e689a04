import re

import duckdb
import pytest

from orograd.llm.fill_middle import BlockTree, fill_middle, fill_middle_report, report_sql

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)
TEXTS = ["", "a", "Hello, world", "é" * 40 + "abc" * 30 + "日本語 x", "word " * 300, "a" * 3000, "1" * 700 + "ab" * 700, "\n\t" * 90]


@pytest.mark.parametrize("block", [1, 3, 16, 512])
def test_cut_is_where_units_begin(block):
    for text in TEXTS:
        tree = BlockTree(text.encode(), block)
        starts = [m.start() for m in UNIT.finditer(text)] + [len(text)]
        assert tree.n == len(starts) - 1
        for k in sorted({*range(0, tree.n + 1, max(1, tree.n // 40)), tree.n}):
            assert tree.cut(k) == (len(text[:starts[k]].encode()), starts[k])


def test_odd_rows_restore_and_equal_sql(spark):
    texts = [*TEXTS, None, "has <M> in it", "ends with <", "S>begins", "x" * 2_000_000 + " é " * 1000]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(1, "a", "x"), (None, "no id at all", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fim_form string")
    got = fill_middle_report(docs)
    con = duckdb.connect()
    frame = docs.toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("documents", frame)
    want = con.sql(report_sql()).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    made = fill_middle(docs)
    assert made.columns == ["doc_id", "text", "fim_form", "fim_output", "fim_form_", "fim_units", "fim_prefix_chars", "fim_middle_chars"]
    again = {r["doc_id"]: r for r in made.collect()}
    assert again[len(TEXTS) + 1]["fim_form_"] == "plain" and again[0]["fim_form_"] == "plain"
    assert {r["fim_form_"] for r in again.values()} >= {"psm", "plain"}


def test_every_text_comes_back(spark):
    docs = spark.createDataFrame([(k, "<" * (k % 4) + "S> <P M> é " * (k % 7) + "M>" * (k % 3)) for k in range(300)], "doc_id long, text string")
    got = fill_middle_report(docs).selectExpr("doc_id", "restored_sha256").join(docs.selectExpr("doc_id", "sha2(text, 256) AS want"), "doc_id")
    assert got.where("restored_sha256 <> want").count() == 0 and got.count() == 300


def test_empty_table(spark):
    assert fill_middle_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []
