import __spark_entry__ as e
import corpus_pipeline as P
from orograd.llm import entry, lines, ngram_join


def test_stages_on_the_given_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = start = spark.read.parquet(f"{d}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, d)
        kept[name] = out
        if name != "packing":
            assert out.columns == start.columns and out.dtypes == start.dtypes
            docs = P.written(out, name)
    ids = {n: {r["doc_id"] for r in df.select("doc_id").collect()} for n, df in kept.items()}
    assert ids["toxicity"] >= ids["line_dedup"] >= ids["ngram_join"] >= ids["decontamination"] == ids["packing"]
    assert len(ids["decontamination"]) > 100
    assert ngram_join.ngram_join(kept["ngram_join"]).where("n_links > 0").count() == 0
    assert lines.line_report(kept["line_dedup"]).where("size(dropped) > 0").count() <= 1
    rows = P.run(spark, d).select("doc_id", "piece", "length").collect()
    assert {r["doc_id"] for r in rows} == ids["packing"]


def test_odd_documents_pass(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a line without an id", "en", "s", 20), (3, "x" * 100_000, "en", "s", 100_000),
            (4, "same text here for two rows", "en", "s", 27), (4, "same text here for two rows", "en", "s", 27), (5, "same text here for two rows", "en", "s", 27)]
    d = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    out = P.run(spark, d).collect()
    assert sorted((r["doc_id"] for r in out if r["doc_id"] is not None and r["piece"] == 0)) == [1, 2, 3, 4]
    assert sum(r["doc_id"] is None for r in out) == 1


def test_registered_queries():
    names = [k for k in e.queries() if k.startswith("op")]
    assert [k.split("_")[0] for k in sorted(names, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in e.queries() and set(entry.oracle_sql()) <= set(e.queries()) and P.ORACLE_SQL is None
