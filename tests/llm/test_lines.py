import random

import numpy as np

from orograd.llm import lines as L

SCHEMA = "doc_id long, text string, line string, h int, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, 2) for k, t in rows], SCHEMA)


def edit(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a):
        q = [i + 1]
        for j, y in enumerate(b):
            q.append(min(p[j] + (x != y), p[j + 1] + 1, q[j] + 1))
        p = q
    return p[-1]


def test_bounded_distance():
    r = random.Random(1)
    for _ in range(1500):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in "ab")
        if r.random() < 0.3:
            a, b = a * 7, a[:r.randint(0, len(a))] + b + a[r.randint(0, len(a)):]
        d = edit(a, b)
        assert all(L.distance_within(a, b, m) == (d <= m) for m in (d - 1, d, d + 1))


def test_fingerprints_equal_plain_counting():
    rng = np.random.default_rng(0)
    n = np.array([3, 0, 50, 700, 255, 256, 1])
    w = rng.integers(0, 1 << 64, n.sum(), dtype=np.uint64)
    for k, a, m in zip(n, np.cumsum(n) - n, L.simhashes(w, n)):
        bits = np.unpackbits(w[a:a + k].view(np.uint8).reshape(-1, 8), axis=1).astype(int).sum(axis=0)
        assert m == (np.packbits(2 * bits > k).view(np.uint64)[0] if k else 0)


def near(words, k, mark):
    w = list(words)
    w[k] = mark
    return " ".join(w)


def test_groups_of_near_lines_keep_their_first(spark):
    r = random.Random(5)
    base = [[r.choice("abcdefgh") * r.randint(2, 9) for _ in range(60)] for _ in range(4)]
    rows = [(1, " ".join(base[0]) + "\nlone line one\n\n" + " ".join(base[1])),
            (2, "lone line two\n" + " ".join(base[0]).upper() + "\nshort"),       # equal after normalising
            (3, near(base[1], 5, "zz") + "\nshort\nshort"),
            (4, "\n".join(near(base[2], k, f"q{k}") for k in range(40))),          # a crowd within one document
            (5, None), (6, ""), (7, "\n \n"), (8, " ".join(base[3])), (9, "...\n!!!\n...")]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(table(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[2] == "lone line two\nshort" and got[3] in ("", near(base[1], 5, "zz"))
    assert got[5] is None and got[6] == "" and got[7] == "\n \n" and got[8] == rows[7][1] and got[9] == "...\n!!!"
    assert got[4].split("\n")[0] == near(base[2], 0, "q0") and len(got[4].split("\n")) < 8
    report = {r["doc_id"]: (r["n_lines"], r["n_kept"], r["dropped"]) for r in L.line_report(table(spark, rows)).collect()}
    assert report[2] == (3, 2, [1]) and report[9] == (3, 2, []) and 5 not in report and report[1] == (3, 3, [])
    assert all(len(got[k].replace("\n\n", "\n").split("\n")) == report[k][1] for k in (1, 2, 4, 8, 9))


def test_large_buckets_and_copies(spark):
    words = "the passage that very many documents share goes on for well over fifty words so that nobody can call it short or a common phrase ".split() * 2
    rows = [(k, near(words, k % 50, f"v{k}") + f"\nown line number {k * 7919} of its own") for k in range(1300)] + [(5000 + k, " ".join(words)) for k in range(300)]
    out = L.line_report(table(spark, rows))
    long = sum(1 for r in out.collect() if r["n_kept"] and 0 not in r["dropped"])
    assert long <= 1300 * 0.05  # nearly all of the near copies are one group, and all equal lines are
    assert {tuple(r["dropped"]) for r in out.where("doc_id > 5000").collect()} == {(0,)}


def test_empty_table(spark):
    assert L.line_report(table(spark, [])).count() == 0 and L.dedup_lines(table(spark, [])).count() == 0


def changed(r, words, letters):
    """The words with one letter of one word changed, or with some words exchanged."""
    w = list(words)
    if letters:
        k = r.choice([i for i, x in enumerate(w) if len(x) > 1])
        c = r.randrange(len(w[k]))
        w[k] = w[k][:c] + "#" + w[k][c + 1:] if r.random() < 0.3 else w[k][:c] + r.choice("xyz") + w[k][c + 1:]
    else:
        for k in r.sample(range(len(w)), max(1, len(w) // 16)):
            w[k] = "".join(r.choice("bcdfg") for _ in range(len(w[k])))
    return " ".join(w)


def test_recall_against_brute_force(spark):
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(2, 9))) for _ in range(900)]
    found = {}
    for letters in (True, False):
        rows, pairs = [], []
        for n in (3, 4, 5, 7, 10, 14, 15, 20, 24, 25, 30, 50, 51, 70, 100, 101, 150, 260):
            for k in range(30):
                line = [r.choice(vocabulary) for _ in range(n)]
                other = changed(r, line, letters)
                line = " ".join(line)
                if other != line and 1 - edit(line, other) / max(len(line), len(other)) >= 0.9 if n <= 30 else L.similar(line, other, 0.9):
                    pairs.append((n, len(rows)))
                    rows += [(len(rows), line), (len(rows) + 1, other)]
        groups = L.line_groups(L.line_table(table(spark, rows), id_col="doc_id", text_col="text"), table(spark, rows))
        group = {x["id"]: x["group_id"] for x in groups.collect()}
        for n, k in pairs:
            found.setdefault((letters, n), []).append(k in group and group[k] == group.get(k + 1))
        sizes = {}
        for g in group.values():
            sizes[g] = sizes.get(g, 0) + 1
        assert max(sizes.values()) == 2     # nothing is glued together
    low = {k: sum(v) / len(v) for k, v in found.items() if sum(v) / len(v) < (0.95 if k[0] else 0.85)}
    assert not low, low
    assert sum(map(sum, found.values())) / sum(map(len, found.values())) >= 0.97


def test_odd_lines(spark):
    url = "https://example.org/" + "abcdefghij" * 8 + "/page"
    rows = [(None, "a line of a row that has no id, long enough to be compared"), (1, "a line of a row that has no id, long enough to be compored"), (2, url), (3, url.replace("page", "pages")),
            (4, "short line a"), (5, "short line b"), (6, "tiny"), (7, "tiny2"), (8, "x " * 300_000 + "end of it"), (9, "w" * 300_000), (10, "!!! ??? ... --- !!! ###"), (1, "another row of id 1")]
    report = {(r["doc_id"], r["n_lines"]): r["dropped"] for r in L.line_report(table(spark, rows)).collect()}
    assert report[3, 1] == [0] and report[5, 1] == [0] and report[7, 1] == [] and report[10, 1] == []
    assert (report[None, 1] == [0]) != (report[1, 2] != [])


def test_pairs_compared_together():
    r = random.Random(3)
    pairs = []
    for _ in range(600):
        a = "".join(r.choice("abcdé𝒳 ") for _ in range(r.choice((1, 12, 30, 60, 61, 90))))
        b = list(a)
        for _ in range(r.randint(0, max(1, len(a) // 7))):
            k = r.randrange(len(b) + 1)
            b[k:k + r.randint(0, 1)] = r.choice(["", "x", "y z"])
        pairs.append((a, "".join(b)) if r.random() < 0.5 else ("".join(b), a))
    pairs += [("", ""), ("", "a"), ("a" * 5000, "a" * 4990 + "b" * 10), ("ab" * 3000, "ba" * 2500)]
    got = L.all_similar(pairs, 0.9)
    want = [edit(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9) if len(a) < 1000 else L.similar(a, b, 0.9) for a, b in pairs]
    assert got.tolist() == want and 100 < sum(want) < 500


def test_words_hashed_together():
    words = L.Words()
    lines = ["one two, two. three", "!!! ---", "Ünder wörd 𝒳y \U0001F600", "w" * 9000 + " " + "w" * 9001, "a b c d", "d c b a"]
    h, n = words(lines)
    assert n.tolist() == [3, 0, 3, 2, 4, 4]
    per = [set(x.tolist()) for x in np.split(h, np.cumsum(n)[:-1])]
    assert per[4] == per[5] and len(set.union(*per)) == 12
    assert all((words([x])[0] == np.sort(y)).all() or set(words([x])[0].tolist()) == set(y.tolist()) for x, y in zip(lines, np.split(h, np.cumsum(n)[:-1])))


def test_few_texts_held_at_once():
    import pyarrow as pa

    from orograd.llm.common import SOME_ROWS, some_rows
    batch = pa.RecordBatch.from_pydict({"text": [None, *map(str, range(3 * SOME_ROWS))]})
    parts = list(some_rows(batch))
    assert max(p.num_rows for p in parts) == SOME_ROWS and pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert [p.to_pylist() for p in some_rows(batch.column(0))] == [p.column(0).to_pylist() for p in parts]
    line = L.xxhash.xxh64_intdigest("a line")
    lost = [line - ((line >> 63) << 64)]
    assert L._without("A  line\nb\n\nb\nB", lost) == "b\n" and L._without(None, lost) is None and L._without("b\nc", None) == "b\nc"


def test_chance_meetings_grow_no_pairs_of_blocks(spark, monkeypatch):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(9)) for _ in range(5002)]
    rows = [(k, " ".join(words[k:k + 3])) for k in range(5000)]                # each line shares two words with the next, none is near
    rows += [(9000, rows[7][1][:-1] + "z"), (9001, rows[2500][1][:-1] + "z")]  # but these two are near to one each
    dealt = []

    def counted(*args):
        dealt.append(block_pairs(*args))
        return dealt[0]

    block_pairs = L.block_pairs
    monkeypatch.setattr(L, "block_pairs", counted)
    monkeypatch.setattr(L, "BLOCK_ROWS", 256)
    report = {x["doc_id"]: x["dropped"] for x in L.line_report(table(spark, rows)).collect()}
    assert {k for k, v in report.items() if v} == {9000, 9001}
    assert dealt[0].count() < 2.5 * len(rows)                                  # pairs of blocks of the one component: twenty times the lines


def test_far_pairs_by_profile():
    r = random.Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abcdé𝒳 ") for _ in range(r.choice((1, 2, 30, 90))))
        b = list(a)
        for _ in range(r.randint(0, 20)):
            k = r.randrange(len(b) + 1)
            b[k:k + r.randint(0, 1)] = r.choice(["", "x", "y"])
        pairs.append((a, "".join(b) or "z"))
    for more in (0, 3):
        far = L._surely_far(*map(list, zip(*pairs)), [max(edit(a, b) + more, 0) for a, b in pairs])
        assert not far.any()
    assert L._surely_far(["abcdefghij" * 9], ["klmnopqrst" * 9], [9]).all()


def test_keys_by_bucket_meet_their_least_line(spark):
    rng = np.random.default_rng(2)
    key, line = rng.integers(0, 60, 400).astype(np.uint64) << np.uint64(58), rng.integers(-9, 9, 400)
    a, b = L._stars(key, line)
    assert set(zip(a.tolist(), b.tolist())) == {(x, m) for k in set(key.tolist()) for own in [line[key == k]] for m in [own.min()] for x in own if x != m}
    rows = L.line_table(table(spark, [(1, "one two three four five six\nshort one here")]), id_col="doc_id", text_col="text").collect()
    packed = [x for x in rows if x["bucket"] is not None]
    assert packed and all(len(x["keys"]) == len(x["owners"]) > 0 and x["id"] is None for x in packed) and [x["line"] for x in rows if x["bucket"] is None] == [0, 1]
    bits = max(8, (2 * L.tasks(spark) - 1).bit_length())
    assert all((np.frombuffer(x["keys"], np.uint64) >> np.uint64(64 - bits) == x["bucket"]).all() for x in packed)
