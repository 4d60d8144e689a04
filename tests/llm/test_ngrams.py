import re

import numpy as np

from orograd.llm import shingles
from orograd.llm.ngram_join import ngram_join

SCHEMA = "doc_id long, text string, node long, n string, bands int"


def table(spark, rows):
    return spark.createDataFrame([(k, t, 1, "x", 2) for k, t in rows], SCHEMA)


def grams(text):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [(k, grams(t)) for k, t in rows]
    links = {i: [j for j, (_, b) in enumerate(sets) if j != i and a and b and len(a & b) / len(a | b) >= 0.8] for i, (_, a) in enumerate(sets)}
    out = []
    for i, (k, _) in enumerate(sets):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((k, min(sets[j][0] for j in seen), len(links[i])))
    return sorted(out)


def test_equals_brute_force_with_crowds_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(words, n))
    rows = [(k, text(rng.integers(5, 120))) for k in range(150)]
    for k in range(60):  # edited copies, some just under the threshold
        w = rows[k][1].split()
        for _ in range(int(rng.integers(1, 5))):
            w[rng.integers(len(w))] = "new"
        rows.append((200 + k, " ".join(w)))
    long = text(200).split()
    for k in range(700):  # more near copies than a block holds
        w = list(long)
        w[k % 200] = f"x{k}"
        rows.append((1000 + k, " ".join(w)))
    rows += [(3000 + k, "The very  same, text. of seven words!") for k in range(40)]
    rows += [(4000, None), (4001, ""), (4002, " \n"), (4003, "..."), (4004, "one two"), (4005, "One, two"), (4006, "two one"), (4007, " ".join(["a"] * 50)), (4008, "a a a a a")]
    rows.append((5000, "word " * 60_000))
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join(table(spark, rows)).collect())
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "alpha beta gamma delta epsilon zeta"
    got = sorted(map(str, ((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join(table(spark, [(1, text), (1, text), (None, text), (7, "other words here now ok")])).collect())))
    assert got == sorted(map(str, [(1, 1, 2), (1, 1, 2), (None, 1, 2), (7, 7, 0)]))
    assert ngram_join(table(spark, [])).count() == 0


def test_band_choice_and_signature():
    bands, rows = shingles.bands_for(0.8, 0.999, 224)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999 and bands * rows <= 224
    rng = np.random.default_rng(0)
    m = shingles.MinHash(bands, rows)
    found = 0
    for _ in range(300):
        a = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        b = np.concatenate([a[:80], rng.integers(0, 1 << 63, 10, dtype=np.uint64)])  # Jaccard 0.8
        found += bool((m.bands(np.unique(a)) == m.bands(np.unique(b))).any())
    assert found >= 297
