import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from orograd.llm import entry
from orograd.llm import packing as P
from orograd.llm.tokens import default_path, encoder

ODD = ["It's we'll THEY'RE!!'s <|endoftext|> x<|startoftext|>y", "café É́ 12345 ½ ªº µ ﬁ Ⅷ", "a\x1cb \x85 c​d  e", "İstanbul ſ ßẞ ΑΣ ΟΔΟΣ", "你好 world😀👍🏽",
       "é x́", "'stop 're'd''ll", "", "   ", "　x y", "×÷ a×b", "don't_stop--now...99%", "x" * 5000]


def test_ids_equal_the_tokenizer():
    t, e = Tokenizer.from_file(default_path()), encoder(default_path())
    for x in ODD:
        assert list(np.frombuffer(e(x), dtype="<u4")) == t.encode(x, add_special_tokens=False).ids, x


def checked(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for o, n in sorted(own):
            assert o == at and n >= 1
            at += n
        assert at <= capacity
    return len(by)


def test_whole_table(spark):
    d, t = "/root/testdata/sf0.01", Tokenizer.from_file(default_path())
    rows = entry.op8_packing(spark, d).collect()
    want = []
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(r["doc_id"], k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert checked(rows, 4096) <= -(-sum(r["length"] for r in rows) // 4096) + 1


def test_rounds_odd_texts_and_ids(spark):
    rows = [(k, x) for k, x in enumerate(ODD)] + [(99, None), (99, None), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, bin string")
    out = P.packed_documents(df, capacity=64, keep_ids=True).collect()
    assert checked(out, 64) >= 1 and sum(r["doc_id"] == 99 for r in out) == 2
    for k in range(len(ODD)):
        ids = b"".join(r["ids"] for r in sorted((r for r in out if r["doc_id"] == k), key=lambda r: r["piece"]))
        assert ids == encoder(default_path())(ODD[k]) + np.array([1], dtype="<u4").tobytes()
    assert P.packed_documents(df.where("false")).count() == 0
    r = random.Random(3)
    pieces = spark.createDataFrame([(k, r.randint(1, 50)) for k in range(4000)], "k long, length long")
    total = pieces.groupBy().sum("length").first()[0]
    out = P.pack(pieces, capacity=100, group_pieces=300)
    assert checked(out.collect(), 100) <= -(-total // 100) + 1 and out.columns == ["k", "length", "sequence_id", "offset"]
    named = pieces.selectExpr("k AS old_group", "length", "'x' AS meets", "k AS bin")
    assert sorted(r["old_group"] for r in P.pack(named, capacity=100, group_pieces=300).collect()) == list(range(4000))


def test_local_search_empties_bins():
    r = random.Random(9)
    for _ in range(20):
        lengths = np.array([r.randint(20, 60) for _ in range(60)])
        start = np.arange(60)  # a bin for each piece
        end = P.local_search(lengths, start, 100)
        fill = np.bincount(end, weights=lengths)
        assert fill.max() <= 100 and (fill > 0).sum() < 45 and (fill ** 2).sum() > (lengths ** 2).sum()
    assert len(P.best_fit(np.zeros(0, dtype=int), 10)) == 0


def test_search_of_a_large_group_is_quick_and_sound():
    import time
    rng = np.random.default_rng(5)
    began = time.perf_counter()
    for lengths in (rng.integers(1, 4097, 16_384), rng.integers(300, 1700, 16_384), np.full(5000, 1366), rng.integers(1, 3, 16_384)):
        start = P.best_fit(lengths, 4096)
        end = P.local_search(lengths, start, 4096)
        a, b = np.bincount(start, weights=lengths), np.bincount(end, weights=lengths)
        assert b.max() <= 4096 and (b > 0).sum() <= (a > 0).sum() and (b ** 2).sum() >= (a ** 2).sum() and b.sum() == lengths.sum()
    assert time.perf_counter() - began < 30


def test_two_for_one_and_one_for_one():
    # 100 a bin: the second can only be emptied by exchanges
    lengths = np.array([60, 30, 45, 45, 50, 46, 4])
    start = np.array([0, 0, 1, 1, 2, 2, 3])
    fill = np.bincount(P.local_search(lengths, start, 100), weights=lengths)
    assert (fill > 0).sum() == 3 and fill.max() <= 100
