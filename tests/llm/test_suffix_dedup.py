import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from orograd.llm.suffix_dedup import LoserTree, Run, Shape, cells, common, dedup_passages, merged, passage_report


def brute(texts, length):
    seen = Counter()
    for t in texts:
        seen.update(t[i:i + length] for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_loser_tree_keeps_order_and_common_beginnings():
    rng = random.Random(4)
    for k in (1, 2, 3, 7):
        runs = [Run(sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))), b"", 0, (rng.randint(1, 99),)) for _ in range(rng.randint(0, 40))))
                for _ in range(k)]
        again = [Run.unpacked(r.packed()) for r in runs]
        assert [r.entries for r in again] == [r.entries for r in runs]
        out = list(LoserTree(again))
        assert [e[0] for e, _ in out] == sorted(e[0] for r in runs for e in r.entries)
        for (a, _), (b, h) in zip(out, out[1:]):
            assert h == common(a[0], b[0], 0)
        one = merged(again)
        assert sorted(p for e in one.entries for p in e[3]) == sorted(p for r in runs for e in r.entries for p in e[3])
        assert len({e[:3] for e in one.entries}) == len(one.entries)


def test_cells_stand_for_every_string():
    rng = np.random.default_rng(2)
    shape = Shape(40)
    a = rng.integers(97, 100, 3000).astype(np.uint8)
    ends = np.array([0, 30, 70, 1500, 1500, 3000])
    place, least, most, _ = cells(a, ends, shape)
    covered = sorted(p - d for p, lo, hi in zip(place, least, most) for d in range(lo, hi + 1))
    begins = np.concatenate([[0], ends[:-1]])
    assert covered == [i for b, e in zip(begins, ends) for i in range(b, e - 39)]
    assert most.max() < shape.width


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 2000, "range_entries": 30}, {"chunk_bytes": 700, "fan_in": 3, "range_entries": 100}, {"chunk_bytes": 1500, "crowd": 1}])
def test_random_texts_equal_brute_force(spark, sizes):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 40))) for _ in range(12)]
    texts = []
    for k in range(160):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 6))]
        texts.append(" ".join(parts))
    texts += [texts[5]] * 40 + ["a" * 500, "ab" * 300, "x" * 49, "x" * 50, "x" * 51, "", "é" * 60]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in passage_report(docs, length=50, **sizes).collect()}
    want = brute([t.encode() for t in texts], 50)
    assert [got[k] for k in range(len(texts))] == want


def test_odd_rows(spark):
    long = "".join(chr(97 + (k * k * 7 + k // 13) % 26) for k in range(250)) + "q" * 3_000_000
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "z" * 300, 0), (3, "short", 0), (4, long, 0), (4, long, 0)], "doc_id long, text string, kept int")
    got = [tuple(r) for r in passage_report(docs).collect()]
    want = brute([(r["text"] or "").encode() if r["doc_id"] != 4 else b"" for r in docs.collect()], 200)
    assert {g for g in got if g[0] != 4} == {(1, *want[0]), (2, *want[1]), (None, *want[2]), (3, *want[3])}
    n = len(long)
    assert [g for g in got if g[0] == 4] == [(4, n, n, 1, hashlib.sha256(b"").hexdigest())] * 2
    assert passage_report(docs.limit(0)).collect() == []
    spans = {r["doc_id"]: r["spans"] for r in dedup_passages(docs.where("doc_id is null")).collect()}
    assert [(s["from"], s["to"]) for s in spans[None]] == [(0, 300)]
