import random

import pandas as pd

from orograd.llm import entry
from orograd.llm import toxicity as T

SCHEMA = "doc_id long, text string, label int, f string"


def corpus(n=600):
    r = random.Random(4)
    words = ["".join(r.choice(("ka", "lo", "mi", "ren", "sto", "ta")) for _ in range(r.randint(1, 4))) for _ in range(400)]
    bad = "idiot moron stupid worthless scum".split()
    rows, labels = [], []
    for k in range(n):
        w = [r.choice(words) for _ in range(60)]
        toxic = int(k % 5 == 0)
        for b in r.sample(bad, 2) if toxic else ():
            w.insert(r.randrange(len(w)), b)
        rows.append((k, " ".join(w)))
        labels.append((k, toxic))
    return rows, labels


def test_obfuscated_words_are_restored(spark):
    rows, labels = corpus()
    plain = rows[1][1]
    odd = {9001: "1d10t", 9002: "m0r0n", 9003: "stuuupid", 9004: "w0rthle$$", 9005: "s c u m", 9006: "i.d.i.o.t", 9007: "$tup!d", 9008: "M-O-R-O-N"}
    rows += [(k, f"{plain} {w} {plain} {'stupid' if k == 9005 else 'scum'}") for k, w in odd.items()]  # beside one plain word, as toxic texts here hold two
    joined = {9010: "such a s c u m, here", 9011: "oh y o u m o r o n. yes", 9012: "you-m0r0n", 9013: "iddiioott", 9014: "idiiot", 9015: "m o r o n", 9016: "no_1d1ot_here",
              9017: "x" * 395 + "-m0r0n-" + "x" * 300}
    rows += [(k, f"{plain} {w} {plain} stupid") for k, w in joined.items()]
    odd |= joined
    rows += [(9099, f"{plain} scum"), (9100, f"{plain} 100% a b 3rd v1.2 c3po x-ray {plain}"), (9101, None), (9102, ""), (9103, plain * 2000 + " moron scum"), (9104, "!!! 123"), (None, plain), (1, plain)]
    df = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], SCHEMA)
    lab = spark.createDataFrame([*labels, (3, None), (None, 1), (77777, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in T.score(df, T.learn(df, lab)).collect()}
    assert all(got[k] >= 0.5 for k in odd), {odd[k]: got[k] for k in odd}
    assert all(got[k] < 0.5 for k in (9099, 9100, 9101, 9102, 9104, None, 1)) and got[9103] > 0.5
    assert all((got[k] >= 0.5) == bool(t) for k, t in labels)
    assert T.score(df.where("false"), T.learn(df, lab)).count() == 0
    flat = T.learn(df, lab.where("false"))
    assert {r["score"] for r in T.score(df, flat).collect()} == {0.25}


def test_given_tables(spark):
    d = "/root/testdata/sf0.01"
    p = entry.op7_toxicity(spark, d).toPandas().merge(pd.read_parquet(f"{d}/labels.parquet"), on="doc_id")
    clean = p[p.toxic == 0]
    assert clean.predicted.mean() < 0.03 and p[p.toxic == 1].predicted.mean() > 0.5


def test_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    p = entry.op7_toxicity(spark, d).toPandas().merge(pd.read_parquet(f"{d}/labels.parquet"), on="doc_id")
    held = p[p.held_out]
    toxic, rest = held[held.toxic == 1], held[held.toxic == 0]
    assert ((p.score >= 0.5).astype(int) == p.predicted).all() and p.score.between(0, 1).all()
    assert len(toxic) > 50 and toxic.predicted.mean() >= 0.85 and rest.predicted.mean() < 0.01


def test_grams_are_those_of_words():
    table = T.symbol_table()
    text = "the cat's 2 ñus é x \U00010428\U00010429 ﬁ"
    want = []
    for w in T.WORD.findall(text):
        k = [0, 0, *map(T.symbol, w), T.END]
        want += [(k[i] * T.SYMBOLS + k[i + 1]) * T.SYMBOLS + k[i + 2] for i in range(len(k) - 2)]
    assert sorted(T.gram_numbers(text, table).tolist()) == sorted(want)
