"""Exact ranked lexical search: ball trees over sparse document vectors, best-first with safe bounds."""

from __future__ import annotations

import heapq
import math
import sys
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 50
BLOCK_DOCS = 2048        # documents of one tree
LEAF_DOCS = 24
BATCH_TERMS = 50_000     # query terms, with repeats, that one pass over the documents answers
ROUND_GROWTH = 32        # a round asks so many times the blocks of those before, with their results as bounds
SCALE = 1_000_000_000
SLACK = 1.0 + 2.0 ** -30  # more than all rounding errors of a bound's sums

# letters of a term: digits, letters, every code point from U+0080 on; only A to Z change case (fixed values)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order."""
    return text.translate(_FOLD).split()


def query_terms(queries: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, terms): the distinct terms of each query that has any."""
    def cut(batches):
        for pdf in batches:
            own = [sorted({t.decode("utf-8") for t in terms(x)}) for x in pdf["text"]]
            yield pd.DataFrame({"item": pdf["item"], "terms": own})

    kind = queries.schema[item_col].dataType.simpleString()
    rows = queries.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")
    return rows.mapInPandas(cut, f"item {kind}, terms array<string>").where(F.size("terms") > 0)


def term_blocks(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str, block_docs: int) -> DataFrame:
    """Documents as counts of the vocabulary's terms, in blocks of `block_docs` that one task reads in turn.

    Rows (block, n_docs, n_terms, df_term, df, id, n, ends, term, tf): figures of all documents of the
    block first, then those that hold a term of the vocabulary, in CSR form, ordered by id.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        from pyspark import TaskContext

        known, part, seq = vocabulary, TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        n_docs = n_terms = 0

        def block():
            nonlocal seq, n_docs, n_terms
            held.sort(key=lambda r: (r[0] is None, r[0]))  # a NULL id is the last of equal scores
            sizes = [len(r[2]) for r in held]
            term = np.concatenate([r[2] for r in held]) if held else np.zeros(0, dtype=np.int32)
            df_term, df = np.unique(term, return_counts=True)
            row = {"block": part << 32 | seq, "n_docs": n_docs, "n_terms": n_terms, "df_term": df_term, "df": df,
                   "id": [r[0] for r in held], "n": [r[1] for r in held], "ends": np.cumsum(sizes, dtype=np.int64), "term": term,
                   "tf": np.concatenate([r[3] for r in held]) if held else np.zeros(0, dtype=np.int32)}
            seq, n_docs, n_terms = seq + 1, 0, 0
            held.clear()
            return pd.DataFrame([row])

        for pdf in batches:
            for key, text in zip(pdf["id"].astype(object), pdf["text"]):
                own = terms(text) if text else ()
                if not own:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(own)
                tf = Counter([known[t] for t in own if t in known])
                if tf:
                    order = sorted(tf)
                    held.append((None if pd.isna(key) else key, len(own), np.array(order, dtype=np.int32), np.array([tf[t] for t in order], dtype=np.int32)))
                if n_docs >= block_docs:
                    yield block()
        if n_docs:
            yield block()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInPandas(cut, f"block long, n_docs long, n_terms long, df_term array<int>, df array<long>, id array<{kind}>, n array<long>, "
                                 "ends array<long>, term array<int>, tf array<int>")


class BallTree:
    """Ball tree over sparse vectors (CSR: ends, term, value) that answers inner products exactly.

    A node keeps its centroid, the greatest distance of a member from it, and per coordinate the
    greatest distance above it. For a query q no member exceeds <q, centroid> + the smaller of
    |q| * radius and <q, coordinate radii>; values and weights are integers below 2^53, the sums of
    doubles are widened by SLACK, so a bound is never too low.
    """

    def __init__(self, ends: np.ndarray, term: np.ndarray, value: np.ndarray, width: int, leaf: int = LEAF_DOCS) -> None:
        self.starts, self.ends, self.term, self.value, self.width = np.concatenate([[0], ends[:-1]]), ends, term, value, width
        self.norm = np.add.reduceat(value.astype(np.float64) ** 2, self.starts)
        self.nodes: list[tuple[int, int, np.ndarray]] = []   # left child, right child, rows of a leaf
        self.centre: list[np.ndarray] = []
        self.above: list[np.ndarray] = []
        self.radius: list[float] = []
        self._grow(np.arange(len(ends)), leaf)
        self.centre, self.above = np.array(self.centre), np.array(self.above)
        self.radius = np.array(self.radius)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries and where each row begins among them."""
        sizes = self.ends[rows] - self.starts[rows]
        first = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.starts[rows] - first, sizes), first

    def _distances(self, rows: np.ndarray, places: np.ndarray, first: np.ndarray, point: np.ndarray) -> np.ndarray:
        dots = np.add.reduceat(self.value[places] * point[self.term[places]], first)
        return np.sqrt(np.maximum(self.norm[rows] + point @ point - 2.0 * dots, 0.0))

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        out[self.term[self.starts[row]:self.ends[row]]] = self.value[self.starts[row]:self.ends[row]]
        return out

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        places, first = self._entries(rows)
        centre = np.bincount(self.term[places], weights=self.value[places], minlength=self.width) / len(rows)
        top = np.zeros(self.width)
        np.maximum.at(top, self.term[places], self.value[places])
        far = self._distances(rows, places, first, centre)
        me = len(self.nodes)
        self.nodes.append((-1, -1, rows))
        self.centre.append(centre)
        self.above.append(np.maximum(top - centre, 0.0))
        # rounding of a difference of squares is bounded by the squares themselves
        self.radius.append(math.sqrt(far.max() ** 2 + 1e-12 * (self.norm[rows].max() + centre @ centre)) * SLACK)
        if len(rows) <= leaf:
            return me
        a = self._dense(rows[int(far.argmax())])
        to_a = self._distances(rows, places, first, a)
        to_b = self._distances(rows, places, first, self._dense(rows[int(to_a.argmax())]))
        lead = to_a - to_b
        half = lead <= np.partition(lead, len(rows) // 2)[len(rows) // 2]
        if half.all():  # all alike, or too many ties at the middle
            half = np.arange(len(rows)) < len(rows) // 2
        left, right = self._grow(rows[half], leaf), self._grow(rows[~half], leaf)
        self.nodes[me] = (left, right, rows[:0])
        return me

    def search(self, query: np.ndarray, weight: np.ndarray, k: int, least: tuple[int, object] | None, ids: list) -> list[tuple[int, int]]:
        """The k best (score, row), equal scores by row; only what can beat `least` (score, id) is looked for."""
        w = weight.astype(np.float64)
        base = self.centre[:, query] @ w
        bound = (base + np.minimum(np.sqrt(w @ w) * self.radius, self.above[:, query] @ w)) * SLACK + 1.0
        spread = np.zeros(self.width, dtype=np.int64)
        spread[query] = weight
        floor = max(least[0], 1) if least else 1
        heap, best = [(-bound[0], 0)], []      # best: heap of (score, -row), the worst first
        while heap:
            b, node = heapq.heappop(heap)
            if -b < (best[0][0] if len(best) == k else floor):
                break
            left, right, rows = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-bound[child], child))
                continue
            places, first = self._entries(rows)
            scores = np.add.reduceat(self.value[places] * spread[self.term[places]], first)
            for s, r in zip(scores.tolist(), rows.tolist()):
                if s < floor or (least and s == least[0] and not _before(ids[r], least[1])):
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -r))
                elif (s, -r) > best[0]:
                    heapq.heapreplace(best, (s, -r))
        return [(s, -r) for s, r in best]


def _before(a, b) -> bool:
    """Whether id `a` stands before or at `b` among equal scores; NULL is last."""
    return b is None or (a is not None and a <= b)


def values(tf: np.ndarray, n: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's share in a document's score before its weight, whole numbers rounded down."""
    m = np.array([100 - 50 + (50 * int(x) * n_docs) // n_terms for x in n], dtype=np.int64)
    tf = tf.astype(np.int64)
    return (SCALE * tf) // (1000 * tf + 20 * np.repeat(m, sizes))


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)


def _answer(blocks: DataFrame, asked: list[tuple], df: np.ndarray, figures: tuple[int, int], least: dict, k: int, id_kind: str, item_kind: str) -> DataFrame:
    """Every block's best rows for every query of the batch: (item, id, score)."""
    n_docs, n_terms = figures
    weight = weights(df, n_docs)

    def run(batches):
        for pdf in batches:
            for ids, n, ends, term, tf in zip(pdf["id"], pdf["n"], pdf["ends"], pdf["term"], pdf["tf"]):
                if not len(ends):
                    continue
                used, own = np.unique(term, return_inverse=True)   # the block's own coordinates
                place = np.full(len(df), -1)
                place[used] = np.arange(len(used))
                ids = [None if pd.isna(x) else x for x in ids.tolist()] if hasattr(ids, "tolist") else list(ids)
                tree = BallTree(np.asarray(ends), own, values(np.asarray(tf), n, np.diff(ends, prepend=0), n_docs, n_terms), len(used))
                out = []
                for number, (item, query) in enumerate(asked):
                    q = query[place[query] >= 0]
                    if len(q):
                        out += [(item, ids[r], s) for s, r in tree.search(place[q], weight[q], k, least.get(number), ids)]
                got = pd.DataFrame(out, columns=["item", "id", "score"])
                yield got.astype({"item": object, "id": object, "score": "int64"})

    return blocks.select("id", "n", "ends", "term", "tf").mapInPandas(run, f"item {item_kind}, id {id_kind}, score long")


def search(docs: DataFrame, queries: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP, batch_terms: int = BATCH_TERMS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Rows (item, rank, id, score): each query's k best documents with a score above 0, equal scores by ascending id.

    Term frequencies saturate and are weighed by rarity, all in whole numbers. Queries are answered
    in batches of about `batch_terms` terms, which is all that a task or the driver holds of them. Documents become
    count vectors over a batch's terms in blocks, each block a ball tree; rounds of ever more blocks
    start from the k-th scores of those before, so late blocks return next to nothing. Every block is searched.

    NULL texts and texts without terms are no documents and match nothing, as queries likewise. Rows that repeat an id are
    documents of their own; rows that repeat a query are one. A NULL id stands last among equal scores.
    """
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), queries.schema[item_col].dataType.simpleString()
    items = written(query_terms(queries, item_col, item_text_col).distinct(), "query-terms")
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    batches = max(1, -(-total // batch_terms))
    results = None
    for b in range(batches):  # a batch is a pass over the documents, so work grows with queries times documents
        part = items.where(F.pmod(F.xxhash64("terms"), F.lit(batches)) == b)
        rows = part.collect()  # about batch_terms terms
        names = sorted({t for r in rows for t in r["terms"]})
        vocabulary = {t.encode(): n for n, t in enumerate(names)}
        asked = [(r["item"], np.array([vocabulary[t.encode()] for t in r["terms"]], dtype=np.int64)) for r in rows]
        blocks = written(term_blocks(docs, vocabulary, id_col, text_col, block_docs), "term-blocks")
        n_blocks, n_docs, n_terms = blocks.agg(F.count("*"), F.sum("n_docs"), F.sum("n_terms")).first()
        df = np.zeros(len(names), dtype=np.int64)
        counts = blocks.select(F.explode(F.arrays_zip("df_term", "df")).alias("x")).groupBy(F.col("x.df_term").alias("t")).agg(F.sum("x.df").alias("n"))
        for r in counts.collect():  # one row a term of the batch
            df[r["t"]] = r["n"]
        best = None
        for lo, hi in _rounds(n_blocks):
            bucket = F.pmod(F.xxhash64("block"), F.lit(1_000_000))
            chosen = blocks.where((bucket >= int(lo * 1_000_000)) & (bucket < int(hi * 1_000_000)))
            least = {} if best is None else _least(best, asked, k)
            found = _answer(chosen, asked, df, (n_docs, n_terms), least, k, id_kind, item_kind)
            best = written(_ranked(found if best is None else found.unionByName(best.drop("rank")), k), "ranked")
        if best is not None:
            results = best if results is None else results.unionByName(best)
    if results is None:
        spark = docs.sparkSession
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {id_kind}, score long")
    return results.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _rounds(blocks: int) -> list[tuple[float, float]]:
    """Shares of the blocks, by hash, that each round asks: together all of them."""
    shares = [1.0]
    while blocks * shares[0] > ROUND_GROWTH and len(shares) < 4:
        shares.insert(0, shares[0] / ROUND_GROWTH)
    return list(zip([0.0, *shares[:-1]], shares)) if blocks else []


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _least(best: DataFrame, asked: list[tuple], k: int) -> dict:
    """Number of the query -> (score, id) of its k-th row so far, where it has as many."""
    last = {r["item"]: (r["score"], r["id"]) for r in best.where(F.col("rank") == k).collect()}  # one row a query of the batch
    return {n: last[item] for n, (item, _) in enumerate(asked) if item in last}


def report_sql(k: int = TOP) -> str:
    """The ranking in SQL, by a join on terms."""
    letters = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    fold = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, translate(text, {fold}) AS t FROM documents WHERE text IS NOT NULL),
occ AS (SELECT r, doc_id, unnest(regexp_extract_all(t, {letters})) AS term FROM rows),
lens AS (SELECT r, count(*) AS n FROM occ GROUP BY r),
tot AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM lens),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {fold}), {letters})) AS term FROM benchmark WHERE text IS NOT NULL),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM occ WHERE term IN (SELECT term FROM items) GROUP BY r, doc_id, term),
dfs AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT nd FROM tot) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tfs GROUP BY term),
vals AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * (SELECT nd FROM tot)) // (SELECT nt FROM tot))) AS v
         FROM tfs JOIN lens USING (r)),
scores AS (SELECT item_id, r, doc_id, CAST(sum(w * v) AS BIGINT) AS score FROM items JOIN dfs USING (term) JOIN vals USING (term) GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {k}"""
