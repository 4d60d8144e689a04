"""Similarity join of documents on word n-grams: MinHash bands, then exact Jaccard."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, compared, components, written
from .shingles import MinHash, WordHashes, bands_for, shingle_set, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.999, 224
BLOCK_ROWS = 512
COLUMNS = 8192        # n-grams counted at once in a block
PAIR_COST = 25e-6     # seconds to intersect two sets, and to multiply one cell: which way is faster
CELL_COST = 2e-10


def signatures(docs: DataFrame, *, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, node, n, bands) of every document: a hash of its n-gram set, the set's size, its band hashes."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches):
        chunks, minhash = WordHashes(), MinHash(bands, rows)
        for pdf in batches:
            node, n, out = [], [], []
            for text in pdf["text"]:
                s = shingle_set(word_hashes(text if isinstance(text, str) else None, chunks), width)
                node.append(node_of(s))
                n.append(len(s))
                out.append(minhash.bands(s) if len(s) else np.zeros(0, dtype=np.int64))
            yield pd.DataFrame({"id": pdf["id"], "node": node, "n": n, "bands": out})

    rows_ = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows_.mapInPandas(sign, f"id {kind}, node long, n long, bands array<long>")


def node_of(shingles: np.ndarray) -> int:
    """64-bit hash of a set; with its size and bands it names the set."""
    with np.errstate(over="ignore"):
        x = shingles * np.uint64(0xD6E8FEB86659FD93)
        return int((np.bitwise_xor.reduce(x ^ (x >> np.uint64(31))) + x.sum(dtype=np.uint64) * np.uint64(3)).astype(np.int64)) if len(x) else 0


def overlaps(sets_a: list, sets_b: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j), by whichever way is cheaper; both are exact."""
    ua, ub = np.unique(i), np.unique(j)
    flat = np.concatenate([*[sets_a[k] for k in ua], *[sets_b[k] for k in ub]])
    names, counts = np.unique(flat, return_counts=True)
    names = names[counts > 1]
    if len(i) * PAIR_COST <= len(ua) * len(ub) * len(names) * CELL_COST:
        return np.array([len(np.intersect1d(sets_a[p], sets_b[q], assume_unique=True)) for p, q in zip(i, j)], dtype=np.int64)
    both = np.zeros((len(ua), len(ub)), dtype=np.float32)
    for lo in range(0, len(names), COLUMNS):
        part = names[lo:lo + COLUMNS]
        both += _matrix(sets_a, ua, part) @ _matrix(sets_b, ub, part).T
    return both[np.searchsorted(ua, i), np.searchsorted(ub, j)].astype(np.int64)


def _matrix(sets: list, which: np.ndarray, names: np.ndarray) -> np.ndarray:
    m = np.zeros((len(which), len(names)), dtype=np.float32)
    for k, w in enumerate(which):
        s = sets[w]
        s = s[np.searchsorted(s, names[0]):np.searchsorted(s, names[-1], side="right")]
        at = np.searchsorted(names, s)
        m[k, at[names[at] == s]] = 1
    return m


def ngram_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
               threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> DataFrame:
    """One row per document: (id, class_id, n_links, n_shingles).

    Links join documents whose sets of `width`-word n-grams have a Jaccard similarity of at least
    `threshold`; `n_links` counts all linked documents, copies too, and `class_id` is the smallest
    id that links lead to. Documents with equal sets are one node with their number. Band and row
    counts are chosen so that a pair just at the threshold is found with probability `recall`.
    Nodes that bands connect are compared in blocks on their full sets; a bucket of any size thus
    spreads over tasks and only a spanning forest and counts leave them.

    A text of fewer than `width` words is one n-gram of all its words. NULL texts and texts without a word
    link with nothing, their class is their own id. Repeated rows are documents of their own with one
    id; a NULL id links and counts but is nobody's class id unless its class has no other.
    """
    bands, rows = bands_for(threshold, recall, hashes)
    signed = written(signatures(docs, id_col=id_col, text_col=text_col, width=width, bands=bands, rows=rows), "signatures")
    nodes = written(signed.where("n > 0").groupBy("node", "n", "bands").agg(F.min("id").alias("witness"), F.count("*").alias("weight")), "nodes")

    keyed = nodes.select(F.col("node").alias("id"), F.explode("bands").alias("key"))
    first = keyed.groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("k")).where("k > 1").drop("k")
    stars = keyed.join(first, "key").where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    near = components(stars, "candidates")
    members = written(near.join(nodes, near["id"] == nodes["node"]).select("id", "component_id", "witness", "weight", "n", "bands"), "members")

    dealt = block_pairs(members, "component_id", F.col("id"), BLOCK_ROWS)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    held = dealt.join(texts, F.col("witness").eqNullSafe(F.col("doc"))).drop("witness", "doc")
    keys = "component_id long, block int, block_a int, block_b int, id long, weight long, bands array<long>"

    def sets(batches):
        chunks = WordHashes()
        for pdf in batches:
            own = [shingle_set(word_hashes(t, chunks), width) for t in pdf["text"]]
            right = [node_of(s) == k for s, k in zip(own, pdf["id"])]  # an id may stand for several texts
            out = pdf.drop(columns=["text", "n"]).assign(s=[s.view(np.int64) for s in own])
            yield out[right]

    def links(a, b, same):
        if not len(a) or not len(b):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        x, y = np.stack(a["bands"].to_list()), np.stack(b["bands"].to_list())
        sa = [s.view(np.uint64) for s in a["s"]]
        sb = sa if same else [s.view(np.uint64) for s in b["s"]]
        met = np.zeros((len(x), len(y)), dtype=bool)
        for k in range(x.shape[1]):
            met |= x[:, k][:, None] == y[:, k][None, :]
        i, j = np.nonzero(np.triu(met, 1) if same else met)
        na, nb = np.array([len(s) for s in sa]), np.array([len(s) for s in sb])
        fits = np.minimum(na[i], nb[j]) >= threshold * np.maximum(na[i], nb[j])
        i, j = i[fits], j[fits]
        if not len(i):
            return i, j
        inter = overlaps(sa, sb, i, j)
        sure = inter >= threshold * (na[i] + nb[j] - inter) - 1e-9
        return i[sure], j[sure]

    order = ["component_id", "block", "block_a", "block_b", "id", "weight", "bands", "n", "text"]
    sets_ = held.select(*order).mapInPandas(sets, f"{keys}, s array<long>")
    found = written(compared(sets_, "component_id", links, once=True), "links")
    group = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "classes")
    group = written(nodes.select(F.col("node").alias("id"), "witness").join(group, "id", "left").withColumn(
        "component_id", F.coalesce("component_id", "id")), "grouped")
    least = group.groupBy("component_id").agg(F.min("witness").alias("class_id"))
    counts = found.groupBy("id").agg(F.sum("n").alias("links"))
    known = written(group.join(least, "component_id").join(counts, "id", "left").join(
        nodes.select(F.col("node").alias("id"), "weight"), "id").select(
        F.col("id").alias("node"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "known")
    out = signed.select("id", F.when(F.col("n") > 0, F.col("node")).alias("node"), F.col("n").alias("n_shingles")).join(known, "node", "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_shingles")

