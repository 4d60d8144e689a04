import re

import pandas as pd

from orograd.llm import decontaminate as D
from orograd.llm import entry

Q = "A train leaves the old station at 9:30 and travels 120 km north while the driver, Maria Lopez, counts 14 bridges along the river before lunch"
FILL = "some plain words that stand around it without any meaning of their own"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, item string, h int")


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_verbatim_changed_and_clean(spark):
    changed = Q.replace("9:30", "7:15").replace("120 km", "85 miles").replace("Maria Lopez", "Anna Schmidt").replace("14", "22")
    twice = "Take 5 apples and 7 pears, then add 5 more apples to the basket that holds the other fruit of the house"
    rows = [(1, f"{FILL}. {Q}. {FILL}"), (2, f"{FILL}. {changed} {FILL}"), (3, FILL), (4, None), (5, ""), (6, Q.lower() + " " + FILL * 3000),
            (7, " ".join(Q.split()[:11])), (8, twice.replace("5", "8")), (9, twice.replace("5", "8", 1)), (10, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"), (1, f"{FILL}. {Q}."), (None, Q)]
    items = [(1, Q), (2, twice), (3, None), (4, ""), (5, "two words"), (6, "9 8 7 6 5 4 3 2 1 0 9 8 7 6")]
    got = {(r["doc_id"], r["item_id"]): r["verbatim"] for r in D.contaminated(docs(spark, rows), bench(spark, items)).collect()}
    assert got == {(1, 1): True, (2, 1): False, (6, 1): True, (8, 2): False, (None, 1): True}
    kept = [r["doc_id"] for r in D.decontaminate(docs(spark, rows), bench(spark, items)).collect()]
    assert sorted(kept) == [3, 4, 5, 7, 9, 10]


def test_short_items_and_empty_tables(spark):
    rows = [(1, "we asked what is the capital today"), (2, "nothing here")]
    assert [r["doc_id"] for r in D.contaminated(docs(spark, rows), bench(spark, [(1, "What is the capital")])).collect()] == [1]
    assert D.contaminated(docs(spark, []), bench(spark, [(1, Q)])).count() == 0
    assert D.contaminated(docs(spark, rows), bench(spark, [])).count() == 0
    assert D.decontaminate(docs(spark, rows), bench(spark, [])).count() == 2


def test_tokens_stand_in_the_same_places(spark):
    from pyspark.sql import functions as F
    text = "In 2020, Peter paid 3.50 dollars for 5km; McDonald said OK. Naïve Ærø  7"
    r = spark.createDataFrame([(text,)], "t string").select(D.canonical_tokens(F.col("t")).alias("c"), D.raw_tokens(F.col("t")).alias("r")).first()
    assert len(r["c"]) == len(r["r"]) and r["c"][:5] == ["in", D.MARK + "n", D.MARK + "p", "paid", D.MARK + "n"] and r["c"][5] == D.MARK + "u"


def test_query_finds_whole_items(spark):
    d = "/root/testdata/sf0.01"
    df = entry.op5_decontaminate(spark, d)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    norm = lambda t: " " + " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " "
    texts, items = pd.read_parquet(f"{d}/documents.parquet"), pd.read_parquet(f"{d}/benchmark.parquet")
    texts = [(k, norm(t)) for k, t in zip(texts.doc_id, texts.text)]
    want = {(k, i) for i, t in zip(items.item_id, items.text) for k, text in texts if norm(t) in text}
    assert {(r["doc_id"], r["item_id"]) for r in df.collect()} == want


def test_passages_and_pieces_of_items(spark):
    words = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "pra", "sto", "tri") for b in ("dar", "fen", "gil", "hom", "jus", "kal", "mer", "nol")]
    long, short = " ".join(words[:59]), " ".join(words[40:57])
    slot = " ".join(words[:20]) + " 5 " + " ".join(words[20:40]) + " then 5 more"
    rows = [(1, f"{FILL} {' '.join(words[10:38])} {FILL}"), (2, f"{FILL} {' '.join(words[40:48])} inserted {' '.join(words[48:57])} {FILL}"),
            (3, f"{FILL} {' '.join(words[:20])} 5 {' '.join(words[20:40])} or 7 more"), (4, f"{FILL} {' '.join(words[10:18])} {FILL}")]
    got = {(r["doc_id"], r["item_id"]): (r["run"], r["item_tokens"], r["verbatim"]) for r in D.contaminated(docs(spark, rows), bench(spark, [(1, long), (2, short), (3, slot)])).collect()}
    assert got[1, 1] == (28, 59, True) and got[2, 2] == (17, 17, True) and got[3, 3][2] and got[3, 3][0] >= 41
    assert not any(k[0] == 4 for k in got)


def test_names_at_sentence_starts_and_of_several_words(spark):
    from pyspark.sql import functions as F
    item = "Alice has 5 apples. Bob has 7 pears. Carol has 9 plums. How many fruits do they have?"
    tom = '"Tom paid for the red boat with 40 dollars," said the old man, and Tom rowed home to the quiet island before dark.'
    rows = [(1, "Dan has 3 apples. Eve has 8 pears. Frank has 6 plums. How many fruits do they have?"), (2, tom.replace("Tom", "Mary Ann").replace("40", "55")),
            (3, tom.replace("Tom", "Mary Ann", 1)), (4, "Paris is the capital of France")]
    got = {(r["doc_id"], r["item_id"]): r["verbatim"] for r in D.contaminated(docs(spark, rows), bench(spark, [(1, item), (2, tom), (3, "What is the capital")])).collect()}
    assert got[1, 1] is False and got[2, 2] is False and not any(k[0] == 4 for k in got)
    text = "In 2020, Mary Ann Smith paid 3.50 dollars for 5 Miles Tom; McDonald said OK. Anna  Lee"
    r = spark.createDataFrame([(text,)], "t string").select(D.canonical_tokens(F.col("t"), True).alias("c"), D.raw_tokens(F.col("t"), True).alias("r")).first()
    assert len(r["c"]) == len(r["r"]) and r["c"][:3] == [D.MARK + "p", D.MARK + "n", D.MARK + "p"] and r["r"][2].strip(D.MARK)[1:] == "mary ann smith"


def test_long_runs_do_not_overflow(spark):
    rows = [(1, "Foo Bar " * 50_000), (2, "1." * 100_000), (3, "x" * 1_000_000), (4, "Xy" * 500_000), (5, "5 km " * 100_000), (6, f"{'Foo ' * 100_000}. {Q}.")]
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs(spark, rows), bench(spark, [(1, Q), (2, "Foo Bar and 1.1.1 of them")])).collect()}
    assert (6, 1) in got and not got & {(3, 1), (4, 1), (5, 1)}


def test_both_tokenisings_stand_in_the_same_places_for_any_text(spark):
    import random

    from pyspark.sql import functions as F
    rng = random.Random(6)
    bits = ["12km", "5 Miles", " ", "\n", "Foo", "BarX", "İstanbul", "Éa", "x", "of ", "1.", ",2", ";", "Mary Ann", "7", D.MARK, "ǅa", "km ", ". ", "\U00010400\U00010428a ", "ß"]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randint(0, 25))),) for _ in range(800)]
    cols = [f(F.col("t"), e).alias(f"{n}{int(e)}") for n, f in (("c", D.canonical_tokens), ("r", D.raw_tokens)) for e in (False, True)]
    for r in spark.createDataFrame(rows, "t string").select("t", *cols).collect():
        for e in "01":
            assert [x[:2] if x.startswith(D.MARK) else x for x in r["r" + e]] == r["c" + e], r["t"]


def brute(texts, items):
    """Documents that hold an item's tokens whole, with every slot exchanged by one rule."""
    def cut(t):
        return [(("n", m[0]) if m[0][0].isdigit() else ("w", m[0].lower())) for m in re.finditer(r"[0-9]+|[a-zA-Z]+", t)]
    out = set()
    for d, t in texts:
        own = cut(t)
        for i, q in items:
            want = cut(q)
            for k in range(len(own) - len(want) + 1):
                slots = {}
                if all(a[0] == b[0] and (a[0] == "n" and slots.setdefault(b[1], a[1]) == a[1] or a == b) for a, b in zip(own[k:], want)):
                    out.add((d, i))
    return out


def test_templates_equal_brute_force(spark):
    import random
    rng = random.Random(8)
    words = "red boat sails over deep green water while old men count nets near stone walls beside quiet hills under grey skies".split()
    items = [(k, " ".join(rng.choice(words) if rng.random() < 0.8 else str(rng.randint(2, 4)) for _ in range(rng.randint(8, 24)))) for k in range(25)]
    # windows of slots mostly are left out by design, so each item has a window of four words at least
    items = [(k, q) for k, q in items if max(sum(w.isalpha() for w in q.split()[j:j + 8]) for j in range(len(q.split()) - 7)) >= 4]
    texts = []
    for k in range(150):
        q = rng.choice(items)[1]
        swap = {n: str(rng.randint(5, 9)) for n in "234"}
        changed = " ".join((swap[w] if rng.random() < 0.9 else "1") if w in swap else w for w in q.split())
        texts.append((k, f"{' '.join(rng.choice(words) for _ in range(9))} {rng.choice([q, changed])} {' '.join(rng.choice(words) for _ in range(9))}"))
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs(spark, texts), bench(spark, items)).where("run = item_tokens").collect()}
    assert got == brute(texts, items) and 60 < len(got)
