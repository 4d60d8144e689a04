import numpy as np
from tokenizers import Tokenizer

from orograd.llm import entry
from orograd.llm import token_files as F_
from orograd.llm.tokens import default_path


def test_counts_of_given_documents(spark):
    d, t = "/root/testdata/sf0.01", Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    got = sorted((r["doc_id"], r["n_tokens"]) for r in entry.op10_token_counts(spark, d).collect())
    want = sorted((r["doc_id"], len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in spark.read.parquet(f"{d}/documents.parquet").collect())
    assert got == want


def test_small_blocks_and_odd_texts(spark):
    texts = [None, "", "one", "<|endoftext|> in a text", "word " * 3000, "", "last one"]
    df = spark.createDataFrame([(k, x, 1, "x") for k, x in enumerate(texts)] + [(2, "one", 1, "x"), (None, "a b", 1, "x")], "doc_id long, text string, block int, ids string").coalesce(2)
    t = Tokenizer.from_file(default_path())
    t.encode_special_tokens = True
    flat = F_.write_flat(df, block_tokens=7)
    order = sorted((r["file"], r["first"] + k, key) for r in flat.where("docs is not null").collect() for k, key in enumerate(r["docs"]))
    counts = {(r["file"], r["ordinal"]): (r["start"], r["n_tokens"], r["ended"]) for r in F_.token_counts(flat).collect()}
    assert len(counts) == len(order) == 9
    want = {**{k: len(t.encode(x or "", add_special_tokens=False).ids) for k, x in enumerate(texts)}, None: 2}
    assert all(counts[f, n][1] == want[key] for f, n, key in order)
    assert F_.document_token_counts(df.where("false")).count() == 0


def test_flat_files_of_others_with_an_open_end(spark, tmp_path):
    rng = np.random.default_rng(1)
    want = {}
    for name in ("a", "b", "c"):
        lengths = rng.integers(0, 40, 200).tolist()
        ids = np.concatenate([np.r_[rng.integers(10, 1000, n), 5] for n in lengths] + [np.arange(10, 13)] * (name == "b")).astype("<u2")
        ids.tofile(tmp_path / name)
        want[name] = [(n, True) for n in lengths] + [(3, False)] * (name == "b")
    (tmp_path / "empty").touch()
    blocks = F_.read_flat(spark, str(tmp_path), block_tokens=16)
    paths = spark.createDataFrame([(str(tmp_path / n), n) for n in want], "path string, name string")
    names = {r["file"]: r["name"] for r in paths.selectExpr("xxhash64(path) as file", "name").collect()}
    old, F_.SPAN = F_.SPAN, 8   # several spans a file
    try:
        got = {}
        for r in sorted(F_.token_counts(blocks, end_id=5).collect(), key=lambda r: (r["file"], r["ordinal"])):
            got.setdefault(names[r["file"]], []).append((r["n_tokens"], r["ended"]))
    finally:
        F_.SPAN = old
    assert got == want
