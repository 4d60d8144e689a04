import numpy as np
import pytest

from orograd.llm.near_vectors import fit_forest, leaves_of, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id double"


def table(spark, rows):
    return spark.createDataFrame([(k, e, 0, "x", 1.0) for k, e in rows], SCHEMA)  # with columns whose names clash


def brute(rows):
    ids = [k for k, _ in rows]
    x = np.array([e for _, e in rows], dtype=np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    comp = list(range(len(ids)))
    changed = True
    while changed:
        new = [min(comp[j] for j in np.flatnonzero(near[i])) for i in range(len(ids))]
        changed, comp = new != comp, new
    low = {c: min(ids[i] for i in range(len(ids)) if comp[i] == c) for c in set(comp)}
    return {ids[i]: (int(near[i].sum()) - 1, low[comp[i]]) for i in range(len(ids))}


def test_equals_brute_force_with_close_and_just_linked_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 32))
    rows = [(1000 + k, e) for k, e in enumerate(base)]
    for k in range(120):  # cosines around the threshold
        e = base[k] / np.linalg.norm(base[k])
        d = rng.standard_normal(32)
        d -= (d @ e) * e
        c = rng.uniform(0.87, 0.99)
        rows.append((k, 3 * (c * e + np.sqrt(1 - c * c) * d / np.linalg.norm(d))))
    rows += [(5000 + k, base[7] + 0.02 * rng.standard_normal(32)) for k in range(80)]   # a crowd of near copies
    rows += [(6000 + k, base[9]) for k in range(60)]                                     # and of equal vectors
    rows = [(k, [float(x) for x in np.asarray(e, dtype=np.float32)]) for k, e in rows]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(table(spark, rows), leaf_rows=60).collect()}
    want = brute(rows)
    assert len(got) == len(rows)
    assert {k: v[:2] for k, v in got.items()} == want
    assert all(v[2] == (k == v[1]) for k, v in got.items())


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, []), (8, [1.0, None]), (9, [3.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(table(spark, rows)).collect()), key=str)
    assert sorted(g for g in got if g[0] is not None) == [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
                                                         (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 3, 1, False)]
    assert [g for g in got if g[0] is None] == [(None, 0, None, True)]
    assert near_vectors(table(spark, [])).count() == 0
    assert near_vectors(table(spark, [(1, None)])).first()["n_links"] == 0


def test_recall_of_the_forest_alone():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = rng.standard_normal((4000, 64))
    d -= (d * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * d / np.linalg.norm(d, axis=1, keepdims=True)  # just at the threshold
    forest = fit_forest(x[:1000], 8000, trees=5, overlap=0.03, leaf_rows=256)

    def own(z):
        out = [set() for _ in z]
        for r, leaf in zip(*leaves_of(z, forest, 0.03)):
            out[r].add(leaf)
        return out

    met = np.mean([bool(a & b) for a, b in zip(own(x), own(y))])
    assert met > 0.995


@pytest.mark.parametrize("name", ["op1_near_vectors"])
def test_query_on_given_table(spark, name):
    from orograd.llm import entry
    import pandas as pd

    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in entry.queries()[name](spark, "/root/testdata/sf0.01").collect()}
    rows = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert got == brute(list(zip(rows.vec_id, rows.embedding)))
